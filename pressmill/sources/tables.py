"""File readers with explicit schemas.

Text formats are meant for intake only; write a corpus once as Parquet (see ``sinks``). Where a
quoted field may span lines, ``records`` finds the records, in as many tasks as a file has
blocks, and Spark parses each. Files without line breaks inside fields are
read once instead of twice; say so with ``multiline=False``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill import constants as C
from pressmill import schemas
from pressmill.functions.pinning import pin
from pressmill.sources.records import read_records

_EXTRA = "_extra_field"


def csv_schema(schema: T.StructType) -> T.StructType:
    """``schema`` and one more field, which only a row with too many fields fills."""
    return T.StructType([*schema.fields, T.StructField(_EXTRA, T.StringType())])


def csv_options(multiline: bool = True, **options: object) -> dict[str, object]:
    """Reader options for quoted fields; columns are taken by position."""
    return {"multiLine": multiline, "quote": '"', "escape": '"', "mode": "PERMISSIVE",
            "enforceSchema": True, **options}


def without_undecoded(table: DataFrame) -> DataFrame:
    """The same without the bytes that could not be decoded, which arrive as U+FFFD."""
    return table.select(*[F.translate(c, "\ufffd", "").alias(c) if t == "string" else F.col(c)
                          for c, t in table.dtypes])


def sound_rows(table: DataFrame) -> DataFrame:
    """Rows without surplus field, without the bytes that could not be decoded. Short rows are padded.

    An extra field that is empty cannot be told from a missing one here, so such a row stays.
    """
    return without_undecoded(table.where(F.col(_EXTRA).isNull()).drop(_EXTRA))


def _read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
              multiline: bool, **options) -> DataFrame:
    """CSV where rows with too many fields, empty ones included, are dropped and short rows padded."""
    if multiline:
        found = read_records(spark, path, str(options.get("sep", ","))).where(F.col("fields") <= len(schema))
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        said = {k: str(v).lower() if isinstance(v, bool) else v for k, v in csv_options(**options).items()}
        row = F.from_csv("record", ddl, {k: v for k, v in said.items() if k not in ("header", "enforceSchema")})
        return without_undecoded(pin(found.select("record"), row=row).select("row.*"))
    return sound_rows(
        spark.read.schema(csv_schema(schema)).options(**csv_options(multiline, **options))
        .csv(list(path) if not isinstance(path, str) else path)
    )


def csv_header(spark: SparkSession, path: str | Sequence[str], multiline: bool = True) -> list[str]:
    """Column names of CSV files, from the first record of the first one."""
    options = csv_options(multiline, header=True, inferSchema=False)
    return spark.read.options(**options).csv(path if isinstance(path, str) else list(path)).columns


def _without_headers(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Leave out the header of every file; fail on one that has the names in another order."""
    row = F.array(*[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names])
    wanted, in_order = F.array(*map(F.lit, names)), F.array(*map(F.lit, sorted(names)))
    another = F.raise_error(F.concat(
        F.lit("a file has its columns in another order: "), F.array_join(row, ",")))
    # Hardly any row has a column name in its first field.
    maybe = row[0].isin(list(names))
    verdict = F.when(~maybe, True).when(row == wanted, False) \
        .when(F.array_sort(row) == in_order, another.cast("boolean")).otherwise(True)
    return table.where(verdict)


def read_articles_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                      header: Sequence[str] | None = None,
                      multiline: bool = True) -> DataFrame:
    """Articles from CSV with a header line; all columns are strings.

    ``header`` states the files' column order; otherwise the first record tells.
    ``columns`` selects some of them. If no field spans lines, pass ``multiline=False``,
    which reads the files once instead of twice.
    """
    names = list(header or csv_header(spark, path, multiline))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    table = _without_headers(_read_csv(spark, path, schema, multiline, header=False), names)
    return table.select(*columns) if columns else table


def read_split(spark: SparkSession, path: str, split: str | None = None,
               metadata: bool = False) -> DataFrame:
    """Processed articles from Parquet, or from CSV if the path ends in ``.csv``.

    On a table partitioned by ``split`` the filter prunes directories.
    """
    schema = schemas.PROCESSED_META if metadata else schemas.PROCESSED
    if path.endswith(".csv"):
        table = read_articles_csv(spark, path, schema.fieldNames())
    else:
        table = spark.read.parquet(path)
    if split is not None:
        table = table.where(F.col("split") == split)
    keep = [*schema.fieldNames(), *(["split"] if "split" in table.columns else [])]
    return table.select(*keep)


def read_claims_tsv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Header-less statement file with 14 tab-separated columns."""
    return _read_csv(spark, path, schemas.CLAIM, multiline, sep="\t", header=False)


def resolve_text_column(columns: Sequence[str]) -> str:
    """First text column present; ``id`` and ``type`` are required."""
    for required in ("id", "type"):
        if required not in columns:
            raise ValueError(f"missing required column: {required}")
    for candidate in C.TEXT_CANDIDATES:
        if candidate in columns:
            return candidate
    raise ValueError(f"no usable text column among {list(columns)}")


def detect_columns(df: DataFrame) -> DataFrame:
    """``id``, ``type``, the text column and the optional columns that exist."""
    text_column = resolve_text_column(df.columns)
    optional = [c for c in C.OPTIONAL_COLUMNS if c in df.columns and c != text_column]
    return df.select("id", "type", text_column, *optional)

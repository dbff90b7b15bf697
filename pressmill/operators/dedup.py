"""Keep-first deduplication as one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.numeric import percent
from pressmill.functions.text import content_hash


def keep_first(df: DataFrame, key: dict[str, Column] | Sequence[str],
               order: Sequence[str] = ("id",)) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the other columns.

    A minimum over structs combines on the map side, so a key that owns a third
    of all rows leaves every map task as a single row. A window would sort that
    key in one task. Columns must have an order, which rules out maps only.
    """
    if not isinstance(key, dict):
        key = {name: F.col(name) for name in key}
    rest = [c for c in df.columns if c not in order]
    packed = F.struct(*[F.col(c) for c in (*order, *rest)])
    grouped = df.groupBy(*[expr.alias(f"_key_{name}") for name, expr in key.items()])
    first = grouped.agg(F.min(packed).alias("_row"))
    return first.select(*[F.col(f"_row.{c}").alias(c) for c in df.columns])


def deduplicate_text(df: DataFrame, text: str = "processed_text",
                     id_column: str = "id") -> DataFrame:
    """Rows with distinct text, told apart by MD5; the lowest id stays."""
    return keep_first(df, {"md5": content_hash(text)}, [id_column])


def deduplicate_id(df: DataFrame, id_column: str = "id",
                   order: Sequence[str] = ()) -> DataFrame:
    """One row per id, first by ``order`` and then by the remaining columns."""
    return keep_first(df, [id_column], order or [id_column])


def duplicate_stats(df: DataFrame, text: str) -> DataFrame:
    """Rows, distinct texts, repeated rows and their rate in percent.

    Counting per digest first sends one row per digest and map task.
    """
    per_text = df.groupBy(content_hash(text).alias("h")).agg(F.count(F.lit(1)).alias("c"))
    totals = per_text.agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("unique_contents"),
    )
    duplicates = F.col("n_rows") - F.col("unique_contents")
    return totals.select(
        "n_rows", "unique_contents",
        duplicates.alias("duplicate_rows"),
        percent(duplicates, F.col("n_rows")).alias("duplicate_percent"),
    )

"""Source metadata joined back onto processed articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.constants import METADATA_COLUMNS
from pressmill.functions.numeric import percent
from pressmill.functions.text import fill_text
from pressmill.operators.dedup import keep_first
from pressmill.session import materialize


def extract_metadata(raw: DataFrame, columns: Sequence[str] = METADATA_COLUMNS,
                     id_column: str = "id", order: Sequence[str] = ()) -> DataFrame:
    """Trimmed metadata, NULL as '', one row per id (first by ``order``).

    Only the id, order and metadata columns are scanned.
    """
    trimmed = raw.select(
        id_column, *[c for c in order if c != id_column],
        *[fill_text(c, trim=True).alias(c) for c in columns],
    )
    return keep_first(trimmed, [id_column], order or [id_column]).select(id_column, *columns)


def merge_metadata(processed: DataFrame, raw: DataFrame,
                   columns: Sequence[str] = METADATA_COLUMNS, id_column: str = "id",
                   order: Sequence[str] = ()) -> DataFrame:
    """Left join of the metadata; unmatched rows get NULL.

    The metadata is written once before the join: the planner then broadcasts it
    only if it is truly small, and otherwise both join inputs are plain
    shuffles, which adaptive execution can split when one id is hot.
    """
    metadata = materialize(extract_metadata(raw, columns, id_column, order), "metadata")
    kept = [c for c in processed.columns if c not in columns]
    return processed.select(*kept).join(metadata, id_column, "left")


def metadata_coverage(merged: DataFrame, columns: Sequence[str] = METADATA_COLUMNS,
                      compat: bool = False) -> DataFrame:
    """Per metadata field the rows that have it, as count and percent.

    ``compat=True`` also counts unmatched (NULL) rows as filled.
    """
    def filled(c: str):
        return (F.col(c) != "") | F.col(c).isNull() if compat else F.col(c) != ""

    counts = merged.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(filled(c)).alias(c) for c in columns],
    )
    return counts.unpivot(["_n"], list(columns), "field", "filled").select(
        "field", "filled", percent(F.col("filled"), F.col("_n")).alias("percent")
    )

"""Columns that are computed exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters refer to instead of recomputing them.

    The optimiser pushes a filter below the projection it reads from and so
    evaluates the projected expression twice: once to filter and once more for
    the output. For tokenising or stemming a text that doubles the cost of the
    whole job. A one-row generator is a boundary no filter is pushed through.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))

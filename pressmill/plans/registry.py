"""Names of the runnable queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def r6(column: Column | str) -> Column:
    """Six decimals: sums run in another order in every engine.

    Rounded on the binary value, half away from zero. Spark's own ``round`` goes
    through the shortest decimal and so sees ties where there are none.
    """
    column = F.col(column) if isinstance(column, str) else column
    millionths = F.floor(F.abs(column) * 1e6 + 0.5).cast("double")
    return F.signum(column) * millionths / 1e6


def rounded(df: DataFrame) -> DataFrame:
    """All double columns at six decimals, all integers as BIGINT."""
    def fit(name: str, kind: str) -> Column:
        if kind in ("double", "float"):
            return r6(name).alias(name)
        if kind in ("int", "smallint", "tinyint"):
            return F.col(name).cast("bigint").alias(name)
        return F.col(name)

    return df.select(*[fit(n, k) for n, k in df.dtypes])

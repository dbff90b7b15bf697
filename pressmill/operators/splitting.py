"""Stratified train / validation / test split, its checks and its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressmill.constants import SEED
from pressmill.functions.numeric import percent
from pressmill.operators.selection import at_or_below, hash_cuts, with_cuts

SPLITS = ("train", "val", "test")


def drop_unusable(df: DataFrame, label: str = "type", text: str = "processed_text") -> DataFrame:
    """Rows that have both a label and a text."""
    return df.where(F.col(label).isNotNull() & F.col(text).isNotNull())


def _tenths(k: int):
    # Integer arithmetic: n * 0.9 is not exact for every n.
    def rank(n: Column) -> Column:
        tenths = n.cast("bigint") * k
        return ((tenths - F.pmod(tenths, F.lit(10))) / 10).cast("bigint")

    return rank


def stratified_split(df: DataFrame, stratum: str = "type", id_column: str = "id",
                     seed: int = SEED) -> DataFrame:
    """Add ``split``: in every class 80 % train, 10 % val, 10 % test.

    Same result as ranking each class by hash and cutting at
    ``rank * 10 <= n * 8`` and ``rank * 10 <= n * 9``, but no class is sorted. ``df``
    is read three times: write it first if it is costly to make.
    """
    cuts = hash_cuts(df, id_column, [stratum],
                     {"_train": _tenths(8), "_val": _tenths(9)}, seed)
    joined = with_cuts(df, cuts, [stratum])
    split = (
        F.when(at_or_below("_train", id_column, seed), F.lit("train"))
        .when(at_or_below("_val", id_column, seed), F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return joined.withColumn("split", split).select(*df.columns, "split")


def split_report(df: DataFrame, label: str = "type") -> DataFrame:
    """Per class the rows in all splits together and in each."""
    counts = df.groupBy(label).pivot("split", list(SPLITS)).count()
    filled = counts.select(label, *[F.coalesce(s, F.lit(0)).cast("bigint").alias(s)
                                    for s in SPLITS])
    total = F.col("train") + F.col("val") + F.col("test")
    return filled.select(label, total.alias("full"), *SPLITS)


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows and percentage of each split."""
    sizes = df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    # At most one row per split is left for this sum.
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(0)))
    return sizes.select("split", "n_rows", percent(F.col("n_rows"), total).alias("percent"))


def split_overlap(df: DataFrame, id_column: str = "id") -> DataFrame:
    """Ids that occur in two splits, counted per pair of splits; all should be 0.

    One pass: each id carries a bit per split, which combines on the map side.
    """
    bit = {name: 1 << i for i, name in enumerate(SPLITS)}
    flag = F.lit(0)
    for name, value in bit.items():
        flag = F.when(F.col("split") == name, F.lit(value)).otherwise(flag)
    per_id = df.groupBy(id_column).agg(F.bit_or(flag).alias("b"))
    pairs = [("train", "val"), ("train", "test"), ("val", "test")]
    both = {
        f"{a}_{b}": F.coalesce(F.sum(F.when(
            F.col("b").bitwiseAND(bit[a] | bit[b]) == (bit[a] | bit[b]), 1
        ).otherwise(0)), F.lit(0)).cast("bigint")
        for a, b in pairs
    }
    counts = per_id.agg(*[expr.alias(name) for name, expr in both.items()])
    return counts.unpivot([], list(both), "pair", "overlap")


def shared_ids(df: DataFrame, one: str, other: str, id_column: str = "id") -> DataFrame:
    """The ids themselves that two splits share."""
    def pick(name: str) -> DataFrame:
        return df.where(F.col("split") == name).select(id_column)

    return pick(one).intersect(pick(other))


def verify_split(source: DataFrame, split: DataFrame, id_column: str = "id") -> None:
    """Raise unless the split holds every row once and no id twice over."""
    expected, found = source.count(), split.count()
    if expected != found:
        raise ValueError(f"size mismatch: {found} rows in the splits, {expected} before")
    bad = split_overlap(split, id_column).where("overlap > 0").collect()
    if bad:
        raise ValueError(f"ids in two splits: {bad}")

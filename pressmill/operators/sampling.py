"""Repeatable samples of exact size, by hash order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.constants import SEED, VOCABULARY_SAMPLE_ROWS
from pressmill.operators.selection import at_or_below, hash_cuts, hash_key, with_cuts

_ALL = "_stratum"


def _share_rank(fraction: float):
    """``round(fraction * n)``, half to even."""
    return lambda n: F.bround(n.cast("double") * F.lit(float(fraction)), 0).cast("bigint")


def stratified_samples(df: DataFrame, fractions: Sequence[float], strata: Sequence[str],
                       id_column: str = "id", seed: int = SEED) -> dict[float, DataFrame]:
    """Samples of several sizes; each holds the smaller ones.

    The cuts of all fractions come from the same two passes.
    """
    names = {f: f"_cut_at_{i}" for i, f in enumerate(fractions)}
    ranks = {name: _share_rank(f) for f, name in names.items()}
    placed = with_cuts(df, hash_cuts(df, id_column, strata, ranks, seed), strata)
    return {
        f: placed.where(at_or_below(name, id_column, seed)).select(*df.columns)
        for f, name in names.items()
    }


def stratified_sample(df: DataFrame, fraction: float, strata: Sequence[str],
                      id_column: str = "id", seed: int = SEED) -> DataFrame:
    """The share ``fraction`` of every stratum, rounded to whole rows."""
    return stratified_samples(df, [fraction], strata, id_column, seed)[fraction]


def random_sample(df: DataFrame, fraction: float, id_column: str = "id",
                  seed: int = SEED) -> DataFrame:
    """The share ``fraction`` of all rows."""
    return stratified_sample(
        df.withColumn(_ALL, F.lit(0)), fraction, [_ALL], id_column, seed
    ).drop(_ALL)


def fixed_size_sample(df: DataFrame, rows: int = VOCABULARY_SAMPLE_ROWS, id_column: str = "id",
                      seed: int = SEED) -> DataFrame:
    """``rows`` rows, or all of them if there are fewer."""
    keyed = df.withColumn(_ALL, F.lit(0))
    cuts = hash_cuts(keyed, id_column, [_ALL],
                     {"_cut": lambda n: F.least(n, F.lit(rows).cast("bigint"))}, seed)
    return (
        with_cuts(keyed, cuts, [_ALL]).where(at_or_below("_cut", id_column, seed))
        .select(*df.columns)
    )


def approximate_sample(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """Cheap Bernoulli sample for exploration: no extra pass, size only expected."""
    return df.sample(fraction=fraction, seed=seed)


def shuffle_rows(df: DataFrame, id_column: str = "id", seed: int = SEED) -> DataFrame:
    """Total pseudo-random order; only meaningful right before a limit or a write."""
    return df.orderBy(hash_key(id_column, seed), id_column)


def first_rows(df: DataFrame, rows: int | None) -> DataFrame:
    """Optional row cap for trial runs."""
    return df if rows is None else df.limit(rows)

"""Exact ranks by hash order, without sorting the data.

Splits and samples need "the first k rows of a class in hash order". A window
over the class would put all its rows into one task. Here the k-th hash of each
class is found in two narrow passes instead, and rows are then compared with it:

1. count rows per (stratum, hash prefix): one partial aggregate, at most 65,536
   counts per stratum;
2. a running sum over those counts names the one prefix in which each wanted
   rank falls; only the rows of that prefix are ranked.

Both passes read the id and stratum columns only, and their results are written
as tiny shared tables, so the planner knows their true size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressmill.constants import SEED
from pressmill.session import materialize

_PREFIX_DIGITS = 4


def hash_key(id_column: str, seed: int = SEED) -> Column:
    """Repeatable pseudo-random order key of a row: MD5 of ``seed:id``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))


def hash_cuts(df: DataFrame, id_column: str, strata: Sequence[str],
              ranks: dict[str, Callable[[Column], Column]], seed: int = SEED) -> DataFrame:
    """Per stratum the order key at each wanted rank.

    ``ranks`` maps an output name to a function from the stratum size to a
    1-based rank. The result has the strata, ``n`` and one struct
    ``(h, id)`` per name; a rank of 0 gives NULL, which no row is below.
    """
    strata = list(strata)
    keyed = df.select(
        *[F.col(s).alias(s) for s in strata],
        hash_key(id_column, seed).alias("h"),
        F.col(id_column).alias("id"),
    ).withColumn("p", F.substring("h", 1, _PREFIX_DIGITS))

    counts = keyed.groupBy(*strata, "p").agg(F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy(*strata)
    running = whole.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = (
        counts.withColumn("n", F.sum("c").over(whole))
        .withColumn("upto", F.sum("c").over(running))
    )
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), rank(F.col("n")).cast("bigint").alias("rank"))
        for name, rank in ranks.items()
    ])
    places = materialize(
        counted.withColumn("w", F.explode(wanted))
        .where((F.col("w.rank") <= F.col("upto"))
               & (F.col("w.rank") > F.col("upto") - F.col("c")))
        .select(*strata, "p", "n", F.col("w.name").alias("name"),
                (F.col("w.rank") - (F.col("upto") - F.col("c"))).alias("local_rank")),
        "rank-places",
    )
    on = [keyed[s].eqNullSafe(places[s]) for s in strata]
    near = keyed.join(places, [*on, keyed["p"] == places["p"]], "inner").select(
        *[places[s].alias(s) for s in strata], places["p"], "n", "name", "local_rank", "h", "id"
    )
    # Rows that share an id share its key and count as one entry here, so an id
    # that is repeated without end does not end up in one task either.
    place = [*strata, "p", "name"]
    entries = near.groupBy(*place, "n", "local_rank", "h", "id").agg(
        F.count(F.lit(1)).alias("c")
    )
    in_prefix = Window.partitionBy(*place).orderBy("h", "id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cuts = (
        entries.withColumn("upto", F.sum("c").over(in_prefix))
        .where((F.col("local_rank") <= F.col("upto"))
               & (F.col("local_rank") > F.col("upto") - F.col("c")))
    )
    return materialize(
        cuts.groupBy(*strata).agg(
            F.max("n").alias("n"),
            *[F.max(F.when(F.col("name") == name, F.struct("h", "id"))).alias(name)
              for name in ranks],
        ),
        "rank-cuts",
    )


def with_cuts(df: DataFrame, cuts: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with the cut columns of their stratum.

    Map-only while the table of cuts (one row per stratum) is small enough for
    the planner to broadcast it.
    """
    strata = list(strata)
    renamed = cuts.select(*[F.col(s).alias(f"_cut_{s}") for s in strata],
                          *[c for c in cuts.columns if c not in strata])
    on = [df[s].eqNullSafe(renamed[f"_cut_{s}"]) for s in strata]
    return df.join(renamed, on, "left").drop(*[f"_cut_{s}" for s in strata])


def at_or_below(cut: str, id_column: str, seed: int = SEED) -> Column:
    """The row's order key is not above the cut; false where the cut is NULL."""
    key = F.struct(hash_key(id_column, seed).alias("h"), F.col(id_column).alias("id"))
    return F.coalesce(key <= F.col(cut), F.lit(False))

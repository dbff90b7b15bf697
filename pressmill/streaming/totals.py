"""Totals that are kept while articles arrive, so that no increment is read twice.

State is a few tables of aggregates that merge by addition, minimum, maximum or union of
sketches. Every batch writes its own part of each table, in a folder named by the batch:
a batch that is replayed after a failure writes the same folder again and so counts
once. Totals are the merge of all parts. ``compact`` merges the parts so far into one;
the folder a reader begins with is named by a last small table, written when all others
are, so a compaction that is cut off changes nothing.

A state belongs to one stream, that is to one checkpoint, whose batch numbers it uses.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pressmill import constants as C
from pressmill.operators import cleaning, profile, sketches
from pressmill.operators.cleaning import judged_articles
from pressmill.session import materialize

_SUM, _LEAST, _MOST = F.sum, F.min, F.max
#: Keys of each table and how its other columns merge.
TABLES: dict[str, tuple[tuple[str, ...], dict]] = {
    "outcomes": (("outcome",), {"n": _SUM}),
    "words": (("word",), {"count": _SUM}),
    "features": (("label", "feature"), {"n": _SUM, "total": _SUM, "squares": _SUM, "least": _LEAST, "most": _MOST}),
    "missing": (("column",), {"missing_count": _SUM}),
    "texts": (("digest",), {"n": _SUM}),
    "sketches": (("label",), {"n": _SUM, "lengths": F.kll_merge_agg_bigint, "texts": F.hll_union_agg}),
}


def batch_parts(judged: DataFrame, features: DataFrame, articles: DataFrame) -> dict[str, DataFrame]:
    """What one set of articles adds to each table."""
    narrow = features.select(F.col("type").alias("label"), "content", *(f"{f}_count" for f in profile.FEATURES))
    values = narrow.unpivot(["label"], [f"{f}_count" for f in profile.FEATURES], "feature", "value")
    exact = F.col("value").cast("decimal(19,0)")
    return {
        "outcomes": judged.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")),
        "words": cleaning.word_counts(judged.where("outcome = 'kept'").select("tokens")),
        "features": values.groupBy("label", F.regexp_replace("feature", "_count$", "").alias("feature")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(exact).cast("decimal(38,0)").alias("total"),
            F.sum((exact * exact).cast("decimal(28,0)")).cast("decimal(38,0)").alias("squares"),
            F.min("value").alias("least"), F.max("value").alias("most")),
        "missing": profile.missing_values(articles),
        "texts": narrow.groupBy(F.md5("content").alias("digest")).agg(F.count(F.lit(1)).alias("n")),
        "sketches": sketches.sketch(narrow, ["label"]),
    }


def _merge(parts: DataFrame, name: str) -> DataFrame:
    keys, measures = TABLES[name]
    return parts.groupBy(*keys).agg(*[
        how(column).cast(parts.schema[column].dataType).alias(column) for column, how in measures.items()])


@dataclass(frozen=True)
class RunningTotals:
    """The state of one stream below ``path``."""

    spark: SparkSession
    path: str

    def _read(self, *folder: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(os.path.join(self.path, *folder))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def merged_up_to(self) -> int:
        """Last batch that is part of the merged tables, or -1."""
        points = self._read("points")
        return -1 if points is None else points.agg(F.max("batch")).first()[0]

    def add(self, parts: Mapping[str, DataFrame], batch: int) -> None:
        """Write what a batch adds; the same batch again replaces it."""
        if batch <= self.merged_up_to():
            return  # a replay of what is merged already
        for name, part in parts.items():
            part.write.mode("overwrite").parquet(os.path.join(self.path, "parts", name, f"batch={batch}"))

    def _parts(self, name: str, above: int) -> DataFrame | None:
        parts = self._read("parts", name)
        merged = self._read("merged", f"batch={above}", name) if above >= 0 else None
        later = None if parts is None else parts.where(F.col("batch") > above).drop("batch")
        if merged is None or later is None:
            return merged if later is None else later
        return merged.unionByName(later)

    def table(self, name: str) -> DataFrame:
        """The totals of one table of ``TABLES``."""
        parts = self._parts(name, self.merged_up_to())
        if parts is None:
            raise ValueError(f"nothing was added to {self.path} yet")
        return _merge(parts, name)

    def compact(self) -> None:
        """Merge all parts; call it between runs of the stream."""
        before, known = self.merged_up_to(), self._read("parts", "outcomes")
        last = -1 if known is None else known.agg(F.max("batch")).first()[0]
        if last <= before:
            return
        for name in TABLES:
            _merge(self._parts(name, before), name).write.mode("overwrite").parquet(
                os.path.join(self.path, "merged", f"batch={last}", name))
        self.spark.createDataFrame([(last,)], "batch int").write.mode("append").parquet(
            os.path.join(self.path, "points"))

    def row_totals(self) -> DataFrame:
        """Rows seen and kept, and dropped by reason."""
        return self.table("outcomes")

    def vocabulary_sizes(self, stop_words: Iterable[str] = C.STOP_WORDS) -> DataFrame:
        """Distinct words and tokens before and after stop words and stemming."""
        return cleaning.vocabulary_sizes_of(self.table("words"), stop_words)

    def feature_stats(self) -> DataFrame:
        """Overall row (``is_total``) and class rows: count, mean, population deviation, least and most."""
        sums = self.table("features").groupingSets([["feature"], ["label", "feature"]], "label", "feature").agg(
            (F.grouping("label") == 1).alias("is_total"), F.sum("n").alias("n"), F.sum("total").alias("total"),
            F.sum("squares").alias("squares"), F.min("least").alias("least"), F.max("most").alias("most"))
        n, total, squares = (F.col(c).cast("double") for c in ("n", "total", "squares"))
        spread = F.greatest(F.lit(0.0), squares / n - (total / n) * (total / n))
        return sums.select("label", "is_total", "feature", F.col("n").alias("count"), (total / n).alias("mean"),
                           F.sqrt(spread).alias("std"), F.col("least").alias("min"), F.col("most").alias("max"))

    def duplicates(self) -> DataFrame:
        """Rows and distinct texts, exact."""
        return self.table("texts").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
                                       F.count(F.lit(1)).alias("unique_contents"))


def add_articles(articles: DataFrame, state: RunningTotals, output: str, batch: int,
                 content: str = "content", stop_words: Iterable[str] = C.STOP_WORDS) -> None:
    """Clean one batch into ``output`` and add it to the totals; the same batch again changes nothing."""
    if batch <= state.merged_up_to():
        return
    arrived = materialize(articles, "batch")
    judged = materialize(judged_articles(arrived, content, stop_words), "judged")
    judged.where("outcome = 'kept'").select("id", "type", "processed_text").write.mode("overwrite").parquet(
        os.path.join(output, f"batch={batch}"))
    features = materialize(profile.analyzed(arrived, content), "features")
    state.add(batch_parts(judged, features, arrived), batch)


def incremental_totals(articles: DataFrame, output: str, state: str, checkpoint: str,
                       content: str = "content", stop_words: Iterable[str] = C.STOP_WORDS) -> StreamingQuery:
    """Process all files that are there and stop: cleaned rows to ``output``, totals to ``state``.

    Read the rows with ``spark.read.parquet(output)``, the totals with ``RunningTotals``.
    """
    listed = list(stop_words)

    def batch(rows: DataFrame, number: int) -> None:
        add_articles(rows, RunningTotals(rows.sparkSession, state), output, number, content, listed)

    return articles.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()

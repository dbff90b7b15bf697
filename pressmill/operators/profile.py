"""Corpus profile: counts, distributions, quantiles, outliers, findings.

``analyzed`` computes the per-article features once; every table below is an
aggregate or a bounded top-k over it. Where a table needs exact order
statistics, rows are first reduced to one count per class and length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressmill import constants as C
from pressmill.functions import text
from pressmill.functions.numeric import safe_divide
from pressmill.session import materialize

FEATURES = ("token", "url", "date", "number")


def class_name(label: Column | str = "type") -> Column:
    """The class, with NULL spelled out as a class of its own."""
    label = F.col(label) if isinstance(label, str) else label
    return F.coalesce(label, F.lit(C.NULL_CLASS))


def analyzed(df: DataFrame, content: str = "content", tokens: bool = False) -> DataFrame:
    """Articles with at least one letter, and their features.

    Columns: ``id, type``, the cleaned ``title, domain, url`` that exist,
    ``content`` cleaned, and ``*_count``. Catalyst drops the features a caller
    does not use.
    """
    optional = [c for c in ("title", "domain", "url") if c in df.columns]
    cleaned = df.where(has_letters(content)).select(
        "id", class_name().alias("type"),
        *[F.coalesce(text.clean_text(c), F.lit("")).alias(c) for c in optional],
        text.clean_text(content).alias("content"),
        text.tokenize_alpha(content).alias("tokens"),
    )
    return cleaned.select(
        "id", "type", *optional, "content",
        *(["tokens"] if tokens else []),
        text.token_count("tokens").cast("bigint").alias("token_count"),
        text.url_count("content").cast("bigint").alias("url_count"),
        text.date_count("content").cast("bigint").alias("date_count"),
        text.number_count("content").cast("bigint").alias("number_count"),
    )


def has_letters(content: Column | str) -> Column:
    """The text has at least one token; stops at the first letter."""
    content = F.col(content) if isinstance(content, str) else content
    return F.lower(content).rlike("[a-z]")


def row_accounting(df: DataFrame, content: str = "content") -> DataFrame:
    """Rows seen, analysed, and without content.

    A text without any letter is in neither of the last two.
    """
    cleaned = F.coalesce(text.clean_text(content), F.lit(""))
    return df.agg(
        F.count(F.lit(1)).alias("rows_seen"),
        F.count_if(has_letters(content)).alias("rows_analyzed"),
        F.count_if(cleaned == "").alias("rows_missing_content"),
    )


def missing_values(df: DataFrame) -> DataFrame:
    """NULLs per column, one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column", "missing_count").orderBy(
        F.desc("missing_count"), "column"
    )


def class_distribution(df: DataFrame, label: str = "type") -> DataFrame:
    """Rows and share of every class, largest first."""
    counts = df.groupBy(class_name(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    # One row per class is left for this sum.
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.select(
        "label", "count", safe_divide(F.col("count"), total).alias("share")
    ).orderBy(F.desc("count"), "label")


def binary_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and percent of each binary label; unlabelled rows are ignored."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("count")
    )
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.select("label", "count", (safe_divide(F.col("count"), total) * 100)
                         .alias("percent"))


def _stats(feature: str, prefix: str) -> list[Column]:
    value = F.col(f"{feature}_count")
    return [
        F.avg(value).alias(f"{prefix}mean"),
        F.stddev_pop(value).alias(f"{prefix}std"),
        F.min(value).alias(f"{prefix}min"),
        F.max(value).alias(f"{prefix}max"),
    ]


def feature_stats(features: DataFrame) -> DataFrame:
    """Count, mean, population deviation, minimum and maximum per feature."""
    wide = [
        expr for feature in FEATURES for expr in _stats(feature, f"{feature}_")
    ]
    return features.agg(F.count(F.lit(1)).alias("count"), *wide)


def feature_stats_by_class(features: DataFrame) -> DataFrame:
    """The same per class."""
    wide = [expr for feature in FEATURES for expr in _stats(feature, f"{feature}_")]
    return features.groupBy(F.col("type").alias("label")).agg(
        F.count(F.lit(1)).alias("count"), *wide
    ).orderBy("label")


def feature_stats_both(features: DataFrame) -> DataFrame:
    """Overall row (``is_total``) and class rows together, in one scan."""
    wide = [expr for feature in FEATURES for expr in _stats(feature, f"{feature}_")]
    return features.groupingSets([[], ["type"]], "type").agg(
        (F.grouping_id() == 1).alias("is_total"), F.count(F.lit(1)).alias("count"), *wide
    ).withColumnRenamed("type", "label")


def feature_means_by_class(features: DataFrame) -> DataFrame:
    """Mean of each feature per class, one row per feature and class."""
    means = features.groupBy(F.col("type").alias("label")).agg(
        *[F.avg(f"{f}_count").alias(f) for f in FEATURES]
    )
    return means.unpivot(["label"], list(FEATURES), "feature", "mean").orderBy(
        "feature", F.desc("mean"), "label"
    )


def length_counts(features: DataFrame) -> DataFrame:
    """Articles per class and token count: the compact form of all lengths."""
    return features.groupBy(F.col("type").alias("label"), "token_count").agg(
        F.count(F.lit(1)).alias("n")
    )


def _explode_quantiles(df: DataFrame, keys: list[str],
                       probabilities: Sequence[float]) -> DataFrame:
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    return df.select(*keys, F.explode(F.arrays_zip(points.alias("q"), F.col("v"))).alias("z")) \
        .select(*keys, F.col("z.q").alias("quantile"), F.col("z.v").alias("token_count"))


def length_quantiles(lengths: DataFrame,
                     probabilities: Sequence[float] = C.LENGTH_QUANTILES) -> DataFrame:
    """Exact, linearly interpolated quantiles of the token count."""
    total = lengths.groupBy("token_count").agg(F.sum("n").alias("n"))
    quantiles = total.agg(
        F.percentile("token_count", list(probabilities), F.col("n")).alias("v")
    )
    return _explode_quantiles(quantiles, [], probabilities)


def length_quantiles_by_class(lengths: DataFrame,
                              probabilities: Sequence[float] = C.LENGTH_QUANTILES) -> DataFrame:
    quantiles = lengths.groupBy("label").agg(
        F.percentile("token_count", list(probabilities), F.col("n")).alias("v")
    )
    return _explode_quantiles(quantiles, ["label"], probabilities)


def length_histogram(lengths: DataFrame, bins: int = C.HISTOGRAM_BINS) -> DataFrame:
    """Articles per equal-width bin of the token count; empty bins are absent.

    The last bin is closed. If all lengths are equal they fall into bin 0 of a
    unit-wide range.
    """
    total = lengths.groupBy("token_count").agg(F.sum("n").alias("n"))
    # The window runs over one row per distinct length.
    everything = Window.partitionBy(F.lit(0))
    low, high = F.min("token_count").over(everything), F.max("token_count").over(everything)
    bounded = total.select("n", "token_count", low.alias("low"), high.alias("high"))
    span = F.col("high") - F.col("low")
    # Integer arithmetic keeps values on a bin edge in the right bin.
    position = F.when(span == 0, F.lit(0)).otherwise(
        F.floor((F.col("token_count") - F.col("low")) * bins / F.nullif(span, F.lit(0)))
    )
    binned = bounded.withColumn("bin", F.least(position, F.lit(bins - 1)).cast("bigint"))
    width = F.max(span.cast("double") / bins)
    return binned.groupBy("bin").agg(
        F.sum("n").cast("bigint").alias("count"),
        (F.max("low") + F.col("bin") * width).alias("lower_edge"),
    ).orderBy("bin")


def top_rows(features: DataFrame, feature: str, k: int = C.OUTLIER_ROWS) -> DataFrame:
    """The ``k`` articles with the highest count; ties go to the lower id."""
    kept = [c for c in ("title", "domain", "url") if c in features.columns]
    score = f"{feature}_count"
    return (
        features.select("id", "type", *kept, text.preview("content").alias("preview"), score)
        .orderBy(F.desc(score), "id").limit(k)
    )


def first_articles(df: DataFrame, content: str = "content", k: int = C.SAMPLE_ROWS) -> DataFrame:
    """The ``k`` articles with the lowest ids among those with a letter, as they came.

    Written once, so that features and stems are made for these rows only.
    """
    return materialize(df.where(has_letters(content)).orderBy("id").limit(k), "first-articles")


def sample_rows(df: DataFrame, content: str = "content", k: int = C.SAMPLE_ROWS) -> DataFrame:
    """The first ``k`` analysed articles with all features."""
    return analyzed(first_articles(df, content, k), content)


def top_words(counts: DataFrame, k: int = C.TOP_WORDS) -> DataFrame:
    return counts.orderBy(F.desc("count"), "word").limit(k)


def rank_frequency(counts: DataFrame, k: int = C.RANK_FREQUENCY_WORDS) -> DataFrame:
    """Frequencies of the ``k`` most frequent words by rank.

    Only ``k`` rows reach the ranking.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("count"), "word")
    return counts.orderBy(F.desc("count"), "word").limit(k).select(
        F.row_number().over(order).cast("bigint").alias("rank"), "word",
        F.col("count").alias("frequency"),
    )


def imbalance_finding(distribution: DataFrame,
                      threshold: float = C.IMBALANCE_RATIO) -> DataFrame:
    """Largest against smallest class; no row unless at least ``threshold`` times."""
    ends = distribution.agg(
        F.min(F.struct((-F.col("count")).alias("c"), F.col("label").alias("label"))).alias("top"),
        F.max(F.struct((-F.col("count")).alias("c"), F.col("label").alias("label"))).alias("low"),
        F.count(F.lit(1)).alias("classes"),
    )
    ratio = safe_divide(F.col("top.c"), F.col("low.c"))
    return ends.where((F.col("classes") >= 2) & (ratio >= threshold)).select(
        F.col("top.label").alias("largest"), F.col("low.label").alias("smallest"),
        ratio.alias("ratio"),
    )


def duplicate_finding(stats: DataFrame, threshold: float = C.DUPLICATE_RATE) -> DataFrame:
    """The duplicate rate, if it is worth reporting."""
    return stats.where(F.col("duplicate_percent") >= threshold * 100)


def class_contrast(by_class: DataFrame) -> DataFrame:
    """Classes with the highest and lowest mean URL and token count, if they differ."""
    ends = []
    for feature in ("url", "token"):
        mean, label = F.col(f"{feature}_mean"), F.col("label")
        ends += [
            F.min(F.struct((-mean).alias("m"), label.alias("label"))).alias(f"{feature}_hi"),
            F.min(F.struct(mean.alias("m"), label.alias("label"))).alias(f"{feature}_lo"),
        ]
    findings = F.array(*[
        F.struct(
            F.lit(feature).alias("feature"),
            F.col(f"{feature}_hi.label").alias("highest"),
            (-F.col(f"{feature}_hi.m")).alias("highest_mean"),
            F.col(f"{feature}_lo.label").alias("lowest"),
            F.col(f"{feature}_lo.m").alias("lowest_mean"),
        )
        for feature in ("url", "token")
    ])
    both = by_class.agg(*ends).select(F.inline(findings))
    return both.where(F.col("highest_mean") > F.col("lowest_mean"))

"""Writers. Parquet is the working format; CSV and JSON are for reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.operators import cleaning, profile
from pressmill.operators.dedup import duplicate_stats
from pressmill.operators.evaluation import confusion_matrix, confusion_table, metrics
from pressmill.session import materialize


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        # Spaces at the ends belong to the value.
        writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False,
                                ignoreTrailingWhiteSpace=False)
    writer.format(fmt).save(path)


def write_processed(df: DataFrame, path: str, preview_path: str | None = None,
                    preview_rows: int = 1_000, fmt: str = "parquet") -> None:
    """Processed articles, and optionally a small preview next to them."""
    write_table(df, path, fmt)
    if preview_path:
        written = df.sparkSession.read.schema(df.schema).format(fmt)
        if fmt == "csv":
            written = written.option("header", True).option("escape", '"')
        write_table(written.load(path).limit(preview_rows), preview_path, fmt)


def append_processed(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(df, path, fmt, mode="append")


def write_splits(df: DataFrame, path: str) -> None:
    """One directory per split, so that readers of one split skip the others."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def _write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A table small by construction, as one file."""
    write_table(df.coalesce(1), path, fmt)


def profile_tables(df: DataFrame, content: str = "content",
                   stop_words: Iterable[str] = C.STOP_WORDS) -> dict[str, DataFrame]:
    """All profile tables. Features and word counts are computed once and shared."""
    features = materialize(profile.analyzed(df, content, tokens=True), "features")
    words = materialize(cleaning.word_counts(features), "word-counts")
    stems = materialize(cleaning.stemmed_word_counts(words, stop_words), "stem-counts")
    lengths = materialize(profile.length_counts(features), "length-counts")
    distribution = profile.class_distribution(features)
    duplicates = duplicate_stats(features, "content")
    by_class = profile.feature_stats_by_class(features)
    counters = {
        "raw": words, "no_stop": cleaning.drop_stopword_rows(words, stop_words),
        "stemmed": stems,
    }
    tables = {
        "rows": profile.row_accounting(df, content),
        "duplicates": duplicates,
        "feature_stats": profile.feature_stats(features),
        "missing_values": profile.missing_values(df),
        "class_distribution": distribution,
        "feature_summary_by_class": by_class,
        "feature_means_by_class": profile.feature_means_by_class(features),
        "token_length_quantiles_overall": profile.length_quantiles(lengths),
        "token_length_quantiles_by_class": profile.length_quantiles_by_class(lengths),
        "token_length_histogram": profile.length_histogram(lengths),
        "rows_with_most_urls": profile.top_rows(features, "url"),
        "rows_with_most_dates": profile.top_rows(features, "date"),
        "rows_with_most_numbers": profile.top_rows(features, "number"),
        "longest_articles": profile.top_rows(features, "token"),
        "analysis_sample_rows": cleaning.sample_rows_with_stems(features, stop_words),
        "finding_imbalance": profile.imbalance_finding(distribution),
        "finding_duplicates": profile.duplicate_finding(duplicates),
        "finding_class_contrast": profile.class_contrast(by_class),
    }
    for name, counts in counters.items():
        tables[f"top_words_{name}"] = profile.top_words(counts)
        tables[f"rank_frequency_{name}"] = profile.rank_frequency(counts)
    return tables


def write_profile(df: DataFrame, path: str, content: str = "content") -> list[str]:
    """Write every profile table: one-row summaries as JSON, the rest as CSV."""
    tables = profile_tables(df, content)
    for name, table in tables.items():
        summary = name in ("rows", "duplicates", "feature_stats")
        _write_report(table, f"{path}/{name}", "json" if summary else "csv")
    return list(tables)


def write_evaluation(predictions: DataFrame, path: str, by: tuple[str, ...] = ("split",),
                     pos_label: int = 0, **settings: object) -> None:
    """Metrics, confusion matrix and run settings of a prediction table."""
    # Predictions are made when they are read; here three reports read them.
    predictions = materialize(predictions.select(*by, "label", "prediction"), "predictions")
    scored = metrics(confusion_matrix(predictions, by, pos_label), by)
    _write_report(scored, f"{path}/metrics")
    _write_report(confusion_table(predictions, by), f"{path}/confusion_matrix")
    summary = scored.select("*", *[F.lit(str(v)).alias(k) for k, v in settings.items()])
    _write_report(summary, f"{path}/summary", "json")

"""Wall-clock time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` optionally some of the queries; ``BENCH_LONG=1`` adds the logistic
grid and the fit-only time of its model. Each query runs once to warm
up the JVM on the small tables beside it, then is timed on the full ones.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pressmill.plans import catalog  # noqa: E402
from pressmill.session import build_session, clear_stages  # noqa: E402

HEADLINE = (
    "class_profile", "processed_articles", "low_quality", "feature_stats_both",
    "length_quantiles_by_class", "duplicate_stats", "vocab_sizes_stemmed", "word_freq_raw",
    "rank_frequency_stemmed", "longest_rows", "merge_metadata", "dedup_processed",
    "stratified_split", "stratified_sample", "tfidf_vocab_bigrams", "tfidf_weights",
    "tfidf_multi_field", "nb_predict", "nb_cross_domain", "metrics_by_split", "linear_svc",
    "sample_rows_stemmed", "top_words", "pipeline_nb",
)
# Four fits over an unlimited vocabulary of unigrams and bigrams take minutes.
LONG = ("logistic_grid",)


def timed(fn, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def fit_only(spark, sf_dir: str) -> dict[str, float]:
    """Seconds of fitting alone: vectors are written, and read, before the clock starts."""
    from pressmill.operators import linear
    from pressmill.plans import stem_queries as Q, views as V

    out = {}
    for name, columns, fields in (("fit_only_svm", ("content",), [Q.BIGRAM_FIELD]),
                                  ("fit_only_logistic", Q.META, Q.BLOCK_FIELDS)):
        if name == "fit_only_logistic" and not os.environ.get("BENCH_LONG"):
            continue
        vectors, _ = Q._vectors(V.labelled(spark, sf_dir, columns=columns), fields)
        train = vectors.where("split = 'train'").persist()
        n = train.count()
        start = time.perf_counter()
        linear.fit_svm(train) if name == "fit_only_svm" else linear.fit_logistic(train, 1.0, n)
        out[name] = round(time.perf_counter() - start, 3)
        train.unpersist()
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    if os.environ.get("BENCH_LONG"):
        chosen = (*chosen, *LONG)
    spark = build_session(f"local[{cpus}]", int(cpus), "bench", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    warm_up = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_up):
        for name in ("class_profile", "processed_articles", "nb_predict"):
            timed(catalog.QUERIES[name], spark, warm_up)
    seconds = {name: round(timed(catalog.QUERIES[name], spark, sf_dir), 3) for name in chosen}
    rows = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).count()
    if not os.environ.get("BENCH_QUERIES"):
        seconds |= fit_only(spark, sf_dir)
    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds[q] for q in chosen), 3),
        "unit": "sec", "queries": seconds, "sf": float(scale) if scale else None,
        "rows_per_second": {name: round(rows / max(s, 1e-3)) for name, s in seconds.items()},
    }))
    clear_stages(spark)
    spark.stop()


if __name__ == "__main__":
    main()

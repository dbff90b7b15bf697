"""Totals over increments, replays and cut-off writes against one pass over everything."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pressmill.operators import cleaning, profile, sketches
from pressmill.streaming import totals
from pressmill.streaming.incremental import article_stream
from pressmill.streaming.totals import RunningTotals, add_articles, batch_parts, incremental_totals


@pytest.fixture(scope="module")
def articles(spark):
    rng = random.Random(1)
    words = ["report", "minister", "market", "walking", "cities", "the", "of", "2024-01-02", "http://x.y/z", "17"] + \
        [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = [(i, rng.choice(["fake", "reliable", None]), " ".join(rng.choices(words, k=rng.randint(1, 120)))) for i in range(150)]
    rows += [(200, "fake", None), (201, None, ""), (202, "fake", "123 456"), (203, "fake", "the of the"),
             (204, "fake", rows[0][2]), (205, "bias", rows[0][2]), (206, "fake", "word " * 60)]
    return spark.createDataFrame(rows, "id bigint, type string, content string")


def everything(state):
    return {name: sorted(map(tuple, state.table(name).drop("lengths", "texts").collect()), key=str)
            for name in totals.TABLES}


def at_once(spark, articles, path):
    state = RunningTotals(spark, str(path))
    add_articles(articles, state, f"{path}-out", 0)
    return everything(state)


def test_increments_and_replays_equal_one_pass(spark, articles, tmp_path):
    state, out = RunningTotals(spark, str(tmp_path / "s")), str(tmp_path / "o")
    parts = [articles.where(f"id % 4 = {i}") for i in range(4)]
    for batch in (0, 1, 1, 2, 2, 3):
        add_articles(parts[batch], state, out, batch)
        if batch == 1:
            state.compact()
            state.compact()
    expected = at_once(spark, articles, tmp_path / "all")
    assert everything(state) == expected
    state.compact()
    add_articles(parts[3], state, out, 3)  # merged already
    assert everything(state) == expected and state.merged_up_to() == 3
    kept = cleaning.processed_articles(articles)
    assert sorted(map(tuple, spark.read.parquet(out).drop("batch").collect())) == sorted(map(tuple, kept.collect()))


def test_cut_off_writes_change_nothing(spark, articles, tmp_path, monkeypatch):
    state, out = RunningTotals(spark, str(tmp_path / "s")), str(tmp_path / "o")
    add_articles(articles.where("id % 2 = 0"), state, out, 0)
    odd = articles.where("id % 2 = 1")
    arrived = cleaning.judged_articles(odd)
    some = batch_parts(arrived, profile.analyzed(odd), odd)
    state.add({k: some[k] for k in ("outcomes", "words")}, 1)  # stopped half way
    add_articles(odd, state, out, 1)  # the stream runs the batch again
    expected = at_once(spark, articles, tmp_path / "all")
    assert everything(state) == expected

    real, done = totals._merge, []

    def failing(parts, name):
        if len(done) == 2:
            raise RuntimeError("executor lost")
        done.append(name)
        return real(parts, name)

    monkeypatch.setattr(totals, "_merge", failing)
    with pytest.raises(RuntimeError):
        state.compact()
    monkeypatch.setattr(totals, "_merge", real)
    assert state.merged_up_to() == -1 and everything(state) == expected
    state.compact()
    assert everything(state) == expected


def test_figures_equal_the_batch_operators(spark, articles, tmp_path):
    state = RunningTotals(spark, str(tmp_path / "s"))
    for batch in range(3):
        add_articles(articles.where(f"id % 3 = {batch}"), state, str(tmp_path / "o"), batch)
    report = cleaning.quality_report(articles).groupBy(
        F.coalesce("drop_reason", F.lit("kept")).alias("outcome")).count()
    found = dict(map(tuple, state.row_totals().collect()))
    assert found.pop("null_text") == 1 and found.pop("no_words") == 3
    assert found == dict(map(tuple, report.collect()))
    assert state.vocabulary_sizes().first() == cleaning.vocabulary_sizes(cleaning.clean_articles(articles)).first()
    stats = profile.feature_stats_both(profile.analyzed(articles)).collect()
    mine = {(r["label"], r["is_total"], r["feature"]): r for r in state.feature_stats().collect()}
    for row in stats:
        for f in profile.FEATURES:
            r = mine[row["label"], row["is_total"], f]
            assert (r["count"], r["min"], r["max"]) == (row["count"], row[f"{f}_min"], row[f"{f}_max"])
            assert math.isclose(r["mean"], row[f"{f}_mean"]) and math.isclose(r["std"], row[f"{f}_std"], abs_tol=1e-6)
    total = next(row for row in stats if row["is_total"])
    assert state.duplicates().first()["n_rows"] == total["count"]


def test_stream_with_several_batches(spark, articles, tmp_path):
    for i in range(3):
        articles.where(f"id % 3 = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = article_stream(spark, str(tmp_path / "in"), articles.schema, files_per_batch=1)
    state = RunningTotals(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError):
        state.table("words")
    incremental_totals(stream, str(tmp_path / "o"), state.path, str(tmp_path / "c")).awaitTermination()
    assert everything(state) == at_once(spark, articles, tmp_path / "all")


def test_sketches_are_close_to_exact(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 3).cast("string").alias("type"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("token_count"),
        (F.col("id") % 45_000).cast("string").alias("content"))
    every = sketches.merged(sketches.sketch(rows, ["type"]))
    values = sorted(r[0] for r in rows.select("token_count").collect())
    for row in sketches.quantiles(every).collect():
        rank = sum(v <= row["value"] for v in values) / len(values)
        assert abs(rank - row["quantile"]) <= 0.01
    counted = sketches.duplicate_stats(every).first()
    assert counted["n_rows"] == 60_000 and abs(counted["unique_contents"] - 45_000) <= 0.03 * 45_000
    empty = sketches.merged(sketches.sketch(rows.limit(0)))
    assert sketches.quantiles(empty).count() == 0 and sketches.duplicate_stats(empty).first()["n_rows"] in (0, None)

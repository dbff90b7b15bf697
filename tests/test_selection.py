"""Exact ranks by hash: splits, samples, deduplication."""

import hashlib

import pytest
from pyspark.sql import functions as F

from pressmill.operators import dedup, metadata, sampling, splitting
from pressmill.operators.selection import hash_cuts


def key(i, seed=42):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i


@pytest.fixture(scope="module")
def rows(spark):
    # One class holds well over a third of all rows, one has a single row.
    data = [(i, "big" if i % 3 else f"c{i % 4}") for i in range(997)] + [(5000, "one")]
    return spark.createDataFrame(data, "id bigint, type string")


def test_split_is_the_windowed_split(spark, rows):
    got = {r["id"]: r["split"] for r in splitting.stratified_split(rows).collect()}
    by_class = {}
    for r in rows.collect():
        by_class.setdefault(r["type"], []).append(r["id"])
    for ids in by_class.values():
        n = len(ids)
        for rank, i in enumerate(sorted(ids, key=key), start=1):
            expected = "train" if rank * 10 <= n * 8 else "val" if rank * 10 <= n * 9 else "test"
            assert got[i] == expected


def test_split_ignores_partitioning(rows):
    one = set(map(tuple, splitting.stratified_split(rows.coalesce(1)).collect()))
    many = set(map(tuple, splitting.stratified_split(rows.repartition(13)).collect()))
    assert one == many


def test_published_stratum(spark):
    rows = spark.range(1_114_003).withColumn("type", F.lit("reliable"))
    sizes = {r["split"]: r["n_rows"] for r in
             splitting.split_sizes(splitting.stratified_split(rows)).collect()}
    assert sizes == {"train": 891_202, "val": 111_400, "test": 111_401}


def test_verify_split(spark, rows):
    split = splitting.stratified_split(rows)
    splitting.verify_split(rows, split)
    with pytest.raises(ValueError, match="size"):
        splitting.verify_split(rows, split.limit(10))
    moved = split.withColumn("split", F.when(F.col("id") == 5000, "val").otherwise(F.col("split")))
    doubled = split.where("id != 0").unionByName(moved.where("id = 5000"))
    with pytest.raises(ValueError, match="two splits"):
        splitting.verify_split(rows, doubled)


@pytest.mark.parametrize("fraction", [0.1, 0.5, 0.07])
def test_samples_have_exact_size(rows, fraction):
    got = [r["id"] for r in sampling.random_sample(rows, fraction).collect()]
    everything = sorted((r["id"] for r in rows.collect()), key=key)
    assert sorted(got, key=key) == everything[: round(fraction * 998)]
    per_class = sampling.stratified_sample(rows, fraction, ["type"]).groupBy("type").count()
    sizes = {r["type"]: r["count"] for r in per_class.collect()}
    for r in rows.groupBy("type").count().collect():
        assert sizes.get(r["type"], 0) == round(fraction * r["count"])


def test_fixed_size_sample(rows):
    assert sampling.fixed_size_sample(rows, 100).count() == 100
    assert sampling.fixed_size_sample(rows, 10**6).count() == 998


def test_null_stratum_and_zero_rank(spark):
    rows = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, type string")
    cuts = hash_cuts(rows, "id", ["type"], {"half": lambda n: F.floor(n / 2)})
    got = {r["type"]: (r["n"], r["half"]) for r in cuts.collect()}
    first = min([1, 2], key=key)
    assert got[None][0] == 2 and got[None][1]["id"] == first
    # No rank of the class "a" is wanted, so it has no cut and no row below it.
    assert "a" not in got
    picked = sampling.stratified_sample(rows, 0.5, ["type"]).collect()
    assert [r["id"] for r in picked] == [first]


def test_keep_first_with_hot_key(spark):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        .alias("processed_text"), (F.col("id") * 2).alias("other"))
    kept = dedup.deduplicate_text(rows)
    assert kept.columns == rows.columns and kept.count() == 2001
    assert kept.where("processed_text = 'hot'").collect()[0]["id"] == 0


def test_keep_first_with_equal_ids(spark):
    rows = spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], "id int, v string")
    assert sorted(map(tuple, dedup.deduplicate_id(rows).collect())) == [(1, "a"), (2, None)]


def test_merge_metadata(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (3, "zz")], "id int, type string")
    raw = spark.createDataFrame(
        [(1, 2, "late", None, None), (1, 1, " first ", "t", None), (3, 1, None, " \t", "a")],
        "id int, seq int, domain string, title string, authors string")
    merged = metadata.merge_metadata(left, raw, order=["seq"])
    got = sorted(map(tuple, merged.collect()), key=str)
    assert got == [(1, "x", "first", "t", ""), (2, "y", None, None, None),
                   (3, "z", "", "", "a"), (3, "zz", "", "", "a")]
    plain = {r["field"]: r["filled"] for r in metadata.metadata_coverage(merged).collect()}
    compat = {r["field"]: r["filled"]
              for r in metadata.metadata_coverage(merged, compat=True).collect()}
    assert plain == {"domain": 1, "title": 1, "authors": 2}
    assert compat == {"domain": 2, "title": 2, "authors": 3}


def test_repeated_ids_stay_together(spark):
    """A third of all rows carries one id; no id may fall into two splits."""
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("id"),
        F.lit("a").alias("type"))
    split = splitting.stratified_split(rows)
    splitting.verify_split(rows, split)
    ranked = sorted((r["id"] for r in rows.collect()), key=key)
    last_train = key(ranked[900 * 8 // 10 - 1])
    got = {r["id"]: r["split"] for r in split.collect()}
    for i in set(ranked):
        assert (got[i] == "train") == (key(i) <= last_train)


def test_row_order_helpers(rows):
    shuffled = [r["id"] for r in sampling.shuffle_rows(rows.repartition(5)).collect()]
    assert shuffled == sorted(shuffled, key=key) and len(shuffled) == 998
    assert sampling.first_rows(rows, 10).count() == 10
    assert sampling.first_rows(rows, None).count() == 998
    assert 300 < sampling.approximate_sample(rows, 0.5).count() < 700

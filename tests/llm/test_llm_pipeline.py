"""Every stage on what its predecessor kept, against brute force, and the whole run."""

import collections

import pytest
from llm_cases import SCHEMA, awkward, union_find, words_of
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from pressmill.llm.common import stage
from pressmill.llm.queries import quality_model, table, toxicity_model
from pressmill.llm import quality, toxicity


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Documents, and what each stage made of them."""
    out = [table(spark, sf_dir, "documents")]
    for _, function in pipeline.STAGES:
        out.append(stage(function(spark, out[-1], sf_dir), "test-stage"))
    return out


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(stages):
    assert len(pipeline.STAGES) == 5
    for df in stages[:-1]:
        assert df.columns == pipeline.COLUMNS
    counts = [df.count() for df in stages[:-1]]
    assert counts[0] > counts[1] > counts[2] > counts[3] >= counts[4] > 0


def test_classifiers_take_effect(spark, sf_dir, stages):
    labels = table(spark, sf_dir, "labels")
    for before, after, fit, module, keep in (
            (stages[0], stages[1], quality_model, quality, lambda s: s >= 0.5),
            (stages[1], stages[2], toxicity_model, toxicity, lambda s: s < 0.5)):
        scores = module.score(before, fit(before, labels)).collect()
        assert {r.doc_id for r in scores if keep(r.score)} == set(rows_of(after))
        source = rows_of(before)
        assert all(source[i] == r for i, r in rows_of(after).items())


def test_one_of_each_group(stages):
    before, after = rows_of(stages[2]), rows_of(stages[3])
    sets = {}
    for i, r in before.items():
        w = r.text.encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = union_find(sets, links)
    assert set(after) == set(root.values()) and all(before[i] == r for i, r in after.items())


def test_repeats_go(stages):
    before, after = rows_of(stages[3]), rows_of(stages[4])
    seen, changed = set(), 0
    for i in sorted(before):
        words = words_of(before[i].text)
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k:k + 20])
            if window in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(window)
        if not any(gone):
            assert after[i] == before[i]
        elif all(gone):
            assert i not in after
        else:
            changed += 1
            assert after[i].text.encode() == b" ".join(w for w, g in zip(words, gone) if not g)
            assert after[i].n_chars == len(after[i].text)
            assert (after[i].lang, after[i].source) == (before[i].lang, before[i].source)
    assert changed


def test_packed(stages, spark, sf_dir):
    whole = collections.Counter()
    for r in stages[5].collect():
        whole[r.doc_id] += r.length
        total = r.doc_tokens
        assert 0 <= r.offset and r.offset + r.length <= 4096 and r.length <= total
    assert set(whole) == set(rows_of(stages[4]))
    assert sorted(map(tuple, pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "ids_crc32").collect())) == \
        sorted(map(tuple, stages[5].select("doc_id", "start", "length", "ids_crc32").collect()))


def test_awkward_tables(spark, sf_dir):
    rows = awkward() + [(None, "no id " * 9), (10, "again " * 9), (20, dict(awkward())[20])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("bigint").alias("n_chars"),
        F.lit(1).alias("score"), F.lit("x").alias("part"))
    assert "score" in SCHEMA
    for given in (docs, docs.where("false")):
        for i, (_, function) in enumerate(pipeline.STAGES):
            given = stage(function(spark, given, sf_dir), "test-awkward")
            if i < 4:
                assert given.columns == pipeline.COLUMNS
    assert given.count() == 0

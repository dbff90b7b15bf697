"""The filter audit against a plain loop over documents and orders."""

import itertools
import random
import re

import pytest

from llm_cases import awkward, words_of
from pressmill.llm import filter_audit

SCHEMA = "doc_id bigint, text string, source string, mask int, part string, h bigint, good int, block int"


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, s, 1, "p", 2, 3, 4) for i, t, s in rows], SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, part string")


def plain(rows, labels):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    known = {}
    for i, q, x, _ in labels:
        good, toxic = known.get(i, (0, 0))
        known[i] = (max(good, int(q == 1)), max(toxic, int(x == 1)))
    found = []
    for i, t, source in rows:
        t, w = t or "", words_of(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": i is not None and i > least[t]}
        found.append((source or "", {f for f, bad in fails.items() if bad}, *(known.get(i, (0, 0)) if i is not None else (0, 0))))
    out = {}
    for part in {p for p, *_ in found}:
        mine = [x[1:] for x in found if x[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, own in enumerate(order, 1):
                here = [x for x in left if own in x[0]]
                left = [x for x in left if own not in x[0]]
                total[own] += len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), sum(own in x[0] for x in mine) - len(here),
                    sum(x[0] == {own} for x in mine), sum(x[1] for x in here), sum(x[2] for x in here), own]
        for key, values in out.items():
            if key[0] == part:
                values[-1] = total[values[-1]]
    return {k: tuple(v) for k, v in out.items()}


def cases():
    rng = random.Random(3)
    rows = [(i, t, rng.choice(["a", "b", None])) for i, t in awkward()]
    rows += [(400 + i, "SAME TEXT # twice", "a") for i in range(30)] + [(450, "", None), (451, None, "c")]
    rows += [(None, "SAME TEXT # twice", "a"), (None, "w", "b"), (10, "another", "b"), (405, "SAME TEXT # twice", "a")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for i, _, _ in rows if i is not None and i % 2]
    return rows, labels + [(11, 1, 0, "x"), (11, 0, 1, "x"), (None, 1, 1, "x"), (999999, 1, 1, "x")]


@pytest.mark.parametrize("limit", [filter_audit.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("cells", [filter_audit.CELLS_A_TEXT, 0])
def test_equals_plain_loop(spark, monkeypatch, limit, cells):
    """With the sketch broadcast or joined; also with one that takes nearly all texts for repeats."""
    monkeypatch.setattr(filter_audit, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(filter_audit, "CELLS_A_TEXT", cells)
    if not cells:
        monkeypatch.setattr(filter_audit, "BLOCK_CELLS", 64)
    rows, labels = cases()
    found = {tuple(r[:3]): tuple(r[3:]) for r in filter_audit.audit(*frames(spark, rows, labels)).collect()}
    assert found == plain(rows, labels)


def test_unique_texts_are_cleared(spark):
    """Of many unique texts hardly one goes on to the exact test; every repeated one does."""
    from pyspark.sql import functions as F

    n = 40_000
    rows = spark.range(n).select(F.xxhash64((F.col("id") - F.col("id") % 100 / 99).cast("int")).alias("h"))
    blocks = -(-n * filter_audit.CELLS_A_TEXT // filter_audit.BLOCK_CELLS)
    assert blocks > 4
    kept = filter_audit._possible(rows, filter_audit.sketch(rows, blocks), blocks)
    twice = rows.groupBy("h").count().where("count > 1").join(rows, "h").count()
    assert twice <= kept.count() < twice + n // 100


def test_no_rows(spark):
    docs, labels = frames(spark, [], [])
    assert filter_audit.audit(docs, labels).count() == 0
    docs, labels = frames(spark, [(1, None, None)], [])
    assert filter_audit.audit(docs, labels).count() == 600

"""Periodic runs against a quadratic search, and grammars against plain comparison."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from llm_cases import awkward, frame, words_of
from pressmill.llm import queries, recompression


def plain_runs(words, shortest=6, exponent=4):
    n, best = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(shortest, exponent * p):
                best.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in best.items())


def texts():
    rng = random.Random(5)
    out = [t for _, t in awkward()]
    for size, letters in ((40, 2), (60, 2), (200, 2), (300, 3), (80, 1)):
        out += [" ".join(rng.choice("abc"[:letters]) for _ in range(size)) for _ in range(20)]
    for _ in range(40):  # nested and neighbouring repetitions
        piece = [rng.choice("abcdef") for _ in range(rng.randint(1, 12))]
        w = [rng.choice("abcdef") for _ in range(rng.randint(0, 20))]
        for _ in range(rng.randint(1, 4)):
            w += piece * rng.randint(1, 9) + piece[:rng.randint(0, len(piece))]
            if rng.random() < 0.5:
                w.insert(rng.randrange(len(w)), "x")
        out.append("\t".join(w) + "\n")
    out += ["a " * 5000, "a b " * 3000 + "c", " ".join("ab"[bin(i).count("1") % 2] for i in range(2000))]
    return out


def collapsed(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("shortest, exponent", [(6, 4), (2, 2), (9, 3)])
def test_runs_of_equals_quadratic_search(shortest, exponent):
    some = [words_of(t)[:900] for t in texts()]
    names = {}
    code = np.array([names.setdefault(w, len(names)) for t in some for w in t], np.int64)
    found = recompression.runs_of(code, np.array([len(t) for t in some]), shortest, exponent)
    expected = [(i, *r) for i, t in enumerate(some) for r in plain_runs(t, shortest, exponent)]
    assert list(zip(*(x.tolist() for x in found))) == expected


def test_extension_equals_plain_comparison():
    rng = np.random.default_rng(1)
    for kind in range(4):
        line = [rng.integers(0, 2, 800), np.zeros(800, int), np.tile(rng.integers(0, 9, 37), 22)[:800],
                rng.integers(0, 300, 800)][kind]
        line = np.append(line, line.max() + 1)
        a, b = rng.integers(0, 800, 3000), rng.integers(0, 800, 3000)
        a, b = a[a != b], b[a != b]
        found = recompression.Grammar(line).extension(a, b)
        for x, y, size in zip(a.tolist(), b.tolist(), found.tolist()):
            assert (line[x:x + size] == line[y:y + size]).all() and line[x + size] != line[y + size]


def test_levels_grow_with_the_logarithm():
    for n in (1000, 100_000):
        assert len(recompression.Grammar(np.arange(n) % 7 * (np.arange(n) % 1000)).levels) < 8 * np.log2(n)


def test_every_row_has_one(spark):
    rows = list(enumerate(texts())) + [(None, "a " * 9), (3, "b " * 9), (3, "b " * 9)]
    found = recompression.periodic_runs(frame(spark, rows), carry=("n", "kept")).collect()
    expected = []
    for i, t in rows:
        runs = plain_runs(words_of(t))
        expected.append((i, len(words_of(t)), runs, collapsed(words_of(t), runs).decode(), 3, "k"))
    key = str
    assert sorted([(r[0], r[1], [tuple(x) for x in r[2]], *r[3:]) for r in found], key=key) == sorted(expected, key=key)
    assert recompression.periodic_runs(frame(spark, [])).count() == 0


def test_query_equals_its_contract(spark, sf_dir):
    found = {r[0]: tuple(r)[1:] for r in queries.op11_recompression(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    planted = 0
    for doc_id, text in docs:
        w, h = words_of(text), zlib.crc32(str(doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
            planted += 1
        runs = plain_runs(w)
        best = (None,) * 4
        for s, length, p in runs:
            if best[0] is None or length * best[2] > best[1] * p:
                best = (s, length, p, 1000 * length // p)
        listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        assert found[doc_id] == (len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(),
                                 hashlib.sha256(collapsed(w, runs)).hexdigest())
    assert planted

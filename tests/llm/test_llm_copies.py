"""Repeated spans, set and vector joins, fingerprints and licence notices against brute force."""

import collections
import hashlib

import duckdb
import numpy as np
import pytest
from llm_cases import awkward, frame, union_find, words_of

from pressmill.llm import components, debruijn, grid_join, licences, part_enum, queries, weighted_sampling


def reduced(rows):
    """One row per id: the least text, a null being the least."""
    out = {}
    for i, t in rows:
        if i is not None and (i not in out or (t is None, out[i] or "") > (out[i] is None, t or "")):
            out[i] = t if i not in out or t is None else min(out[i], t)
    return out


REPEATS = [(None, "no id"), (10, "zzzz " * 30), (20, dict(awkward())[20])]


def test_repeated_spans(spark):
    rows = awkward()
    docs = frame(spark, rows + REPEATS)
    cleaned = debruijn.remove_repeats(docs, spans=True)
    found = {r.doc_id: r for r in cleaned.collect()}
    texts = reduced(rows + REPEATS)
    assert set(found) == set(texts)
    seen, removed = set(), 0
    for i in sorted(texts):
        words = words_of(texts[i])
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k:k + 20])
            if window in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(window)
        removed += sum(gone)
        assert found[i].n_words == len(words) and found[i].n_removed == sum(gone)
        assert found[i].kept.encode() == b" ".join(w for w, g in zip(words, gone) if not g)
        covered = set()
        for span in found[i].spans:
            assert span.length >= 20 and (span.source_doc, span.source_start) < (i, span.start)
            covered |= set(range(span.start, span.start + span.length))
        assert covered == {k for k, g in enumerate(gone) if g}
    assert removed > 500
    assert debruijn.verify(frame(spark, list(texts.items())), cleaned).count() == 0
    assert debruijn.remove_repeats(frame(spark, [])).count() == 0


def shingle_sets(texts, size):
    out = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        out[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}
    return out


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (1, 60)])
def test_similarity_components(spark, size, percent, monkeypatch):
    rows = awkward()
    texts = reduced(rows + REPEATS)
    sets = shingle_sets(texts, size)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    expected = union_find(sets, links)
    assert len(set(expected.values())) < len(sets) - 5
    found = part_enum.similarity_components(frame(spark, rows + REPEATS), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == \
        {i: (len(sets[i]), expected[i]) for i in sets}
    assert part_enum.similarity_components(frame(spark, []), size, percent).count() == 0


@pytest.mark.parametrize("block", [20, 150])
def test_components_over_several_blocks(spark, monkeypatch, block):
    """Also with a block for each set, so that links lie in and between blocks other than the first."""
    monkeypatch.setattr(part_enum, "BLOCK", block)
    words = [f"v{i}" for i in range(80)]
    chain = [(400 + i, " ".join(words[i:i + 50])) for i in range(0, 8)]  # each links to the next ones only
    rows = awkward() + chain
    sets = shingle_sets(dict(rows), 4)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    found = part_enum.similarity_components(frame(spark, rows), 4, 85).collect()
    assert {r.doc_id: r.component_id for r in found} == union_find(sets, links)


@pytest.mark.parametrize("percent", [60, 80, 85, 95])
def test_signatures_lose_no_pair(percent):
    """Random pairs at the threshold, whose sets share a signature always."""
    import pyarrow as pa

    rng = np.random.default_rng(percent)
    for n in [1, 2, 3, 7, 12, 13, 14, 20, 41, 80, 200, 400] * 6:
        base = [f"w{x}" for x in rng.permutation(100_000)[:2 * n]]
        a = base[:n]
        drop = int(rng.integers(0, n * (100 - percent) // 100 + 1))
        add = 0
        while 100 * (n - drop) >= percent * (n + add + 1):
            add += 1
        b = a[drop:] + base[n:n + add]
        if 100 * (n - drop) < percent * (n + add):
            continue
        sets = part_enum._Sets(pa.array([" ".join(a), " ".join(b)]), 1)
        signatures, owner = part_enum._signatures(sets, np.array([0, 1]), percent)
        assert set(signatures[owner == 0]) & set(signatures[owner == 1]), (n, drop, add)


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_sketches_keep_links_and_drop_most_others(percent):
    """Sets at the threshold stay together, also with other numbers of cells; sets with a tenth in common part."""
    import pyarrow as pa

    rng = np.random.default_rng(percent)
    texts = []
    for n in [1, 3, 13, 63, 64, 65, 127, 130, 400, 2000]:
        base = [f"w{n}-{x}" for x in range(3 * n)]
        drop = n * (100 - percent) // 100
        texts += [" ".join(base[:n]), " ".join(base[drop:n])]  # similarity is exactly that or a little more
    many = [" ".join([f"p{i}" for i in range(30)] + [f"q{x}" for x in rng.integers(0, 10**9, 300)]) for _ in range(20)]
    sets = part_enum._Sets(pa.array(texts + many), 1)
    doc = np.arange(len(texts) + len(many))
    for block in (np.zeros(len(doc), np.int64), doc % 2):
        found = part_enum._possible(pa.table([pa.array(doc), pa.array(sets.counts), pa.array(block), sets.sketches()],
                                             ["doc_id", "n", "block", "sketch"]), percent)
        part = dict(zip(found["doc_id"].to_pylist(), found["part"].to_pylist()))
        assert all(part[i] == part[i + 1] for i in range(0, len(texts), 2))
        if percent > 60:
            assert not set(part) & set(range(len(texts), len(doc)))


def test_connected_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1300)]
    links += [(5000, i) for i in range(5001, 5200)] + [(7, 7)]
    found = {r.node: r.component for r in components.components(
        spark.createDataFrame(links, "a bigint, b bigint").repartition(5)).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert found == union_find(nodes, links)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(grid_join, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12))
    x = [(centres[rng.integers(0, 6)] + rng.normal(size=12) * 0.25).astype(np.float32).tolist() for _ in range(300)]
    rows = [(i, v, i % 3, "x") for i, v in enumerate(x)]
    rows += [(1000 + i, x[4], 1, "x") for i in range(30)]  # copies, across many blocks
    rows += [(2000, None, 1, "x"), (2001, [0.0] * 12, 1, "x"), (2002, [float("nan")] + [1.0] * 11, 1, "x"),
             (2003, [None] + [1.0] * 11, 1, "x"), (2004, [float("inf")] + [1.0] * 11, 1, "x"), (2005, x[0], None, "x"),
             (2006, [1.0, 2.0], 1, "x"), (2007, [2.0, 4.0], 1, "x"), (2008, [], 1, "x"),
             (None, x[0], 0, "x"), (7, x[7], 2, "x"), (2009, [1.0] * 12, 1, "x"), (2010, [-1.0] * 12, 1, "x")]
    schema = "vec_id bigint, embedding array<float>, label int, part string"
    table = spark.createDataFrame(rows, schema)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in grid_join.near_duplicates(table).collect()}
    vectors = {}
    for i, v, label, _ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[2] is not None, r[2] or 0)):
        vectors.setdefault(i, (v, label))
    links = []
    for a, (v, la) in vectors.items():
        for b, (w, lb) in vectors.items():
            if a < b and la is not None and la == lb and v and w and len(v) == len(w) and None not in v + w:
                p, q = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if np.isfinite(p).all() and np.isfinite(q).all() and p.any() and q.any() and \
                        p @ q / np.linalg.norm(p) / np.linalg.norm(q) >= 0.93:
                    links.append((a, b))
    component = union_find(vectors, links)
    count = collections.Counter(x for pair in links for x in pair)
    assert len(links) > 500
    assert found == {i: (count[i], component[i], component[i] == i) for i in vectors}
    assert grid_join.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    useless = spark.createDataFrame([(1, None, 1, "x")], schema)
    assert [tuple(r) for r in grid_join.near_duplicates(useless).collect()] == [(1, 0, 1, True)]


def weights(text):
    return {w: n * len(w) for w, n in collections.Counter(words_of(text)).items()}


def test_signatures_estimate_similarity():
    import pyarrow as pa

    texts = [t or "" for _, t in awkward()]
    found = weighted_sampling.signatures(pa.array([*texts, None]), 256)
    errors = []
    for i, a in enumerate(texts):
        for j in range(i):
            p, q = weights(a), weights(texts[j])
            if p and q:
                keys = set(p) | set(q)
                exact = sum(min(p.get(k, 0), q.get(k, 0)) for k in keys) / sum(max(p.get(k, 0), q.get(k, 0)) for k in keys)
                errors.append(weighted_sampling.likeness(found[i:i + 1], found[j:j + 1])[0] - exact)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05
    long = "ab " * 5 + " ".join(f"u{i}" for i in range(20_000))  # more terms than are handled at a time
    again = weighted_sampling.signatures(pa.array(["x", long, "y", long]), 64)
    assert (again[1] == again[3]).all() and (again[1] != 0).all()


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_fingerprints_with_next(spark, ranges):
    rows = awkward()
    found = {r.doc_id: r for r in weighted_sampling.compare_with_next(frame(spark, rows), ranges=ranges).collect()}
    single = {r.doc_id: r.fingerprint for r in weighted_sampling.fingerprints(frame(spark, rows)).collect()}
    texts = {i: t or "" for i, t in rows}
    order = sorted(texts, reverse=True)
    prints = {}
    for i, after in zip(order, order[1:] + order[:1]):
        r, text, half = found[i], texts[i], len(texts[i]) // 2
        assert r.n_chars == len(text) and r.edited == text[:len(text) - half] + texts[after][:half]
        assert r.fingerprint == single[i] and prints.setdefault(text, r.fingerprint) == r.fingerprint
        for other, near in ((r.edited_fingerprint, r.near_edited), (found[after].fingerprint, r.near_next)):
            same = [r.fingerprint[k:k + 8] == other[k:k + 8] for k in range(0, 512, 8)]
            assert near == np.mean(same)
    assert len(found) == len(rows)


def test_fingerprints_of_odd_tables(spark):
    compare = weighted_sampling.compare_with_next
    assert compare(frame(spark, [])).count() == 0
    one = compare(frame(spark, [(5, "abcdef")])).first()
    assert (one.edited, one.near_next) == ("abcabc", 1.0)
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "z"), (None, "q r s t"), (None, None), (2, "m n o p")]
    for ranges in (1, 3):
        found = compare(frame(spark, rows), ranges=ranges).collect()
        assert collections.Counter(r.doc_id for r in found) == {1: 3, None: 2, 2: 1}
        assert {r.edited for r in found if r.doc_id == 2} == {"m n a b"}


def test_licence_scan(spark, sf_dir):
    lines = ["All rights reserved.", "ALL RIGHTS -- reserved", "rights reserved", "MIT", "", "Released under the MIT License.",
             "It is released under the MIT License.", "Licensed under CC BY 4.0", "licensed under cc by nc 4.0!!",
             "Licensed under the Apache License, Version 2.0. " * 3, "x " * 500]
    rows = [(i, line) for i, line in enumerate(lines)] + [(50, "\n".join(lines)), (51, None), (None, lines[0]), (1, lines[0])]
    got = collections.Counter(tuple(r) for r in licences.scan(frame(spark, rows)).collect())

    expected = collections.Counter()
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            grams = set(licences.bigrams(licences.normal_words(line)))
            best = min(((-2 * len(grams & set(own)) / (len(grams) + len(own)), name) for name, own in (
                (n, licences.bigrams(licences.normal_words(t))) for n, t in licences.NOTICES)))
            if -best[0] >= 0.8:
                expected[i, k, best[1], -best[0]] += 1
    assert got == expected and len(got) > 10
    assert licences.scan(frame(spark, [])).count() == 0
    assert licences.scan(frame(spark, rows), templates=[]).count() == 0
    plan = licences.scan(queries.table(spark, sf_dir, "documents"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_licence_windows(spark):
    """Wrapped and embedded notices and whole texts, none of them a line like a template."""
    whole = dict(licences.PASSAGES)
    rows = [
        (1, "some text\n# Licensed under the\n# Apache License, Version 2.0.\nmore text"),
        (2, "Copyright 2020 X. Licensed under the Apache License, Version 2.0. See LICENSE."),
        (3, "Copyright 2020 X\n\n" + whole["MIT"] + "\n\nint main() {}"),
        (4, "x\n" + whole["BSD-2-Clause"]), (5, whole["BSD-3-Clause"].replace("\n", " ")), (6, whole["ISC"]),
        (7, "/* " + whole["Apache-2.0"].replace("\n", "\n * ")), (8, whole["Unlicense"]),
        (9, whole["LGPL-2.1"] + "\n\n" + whole["EPL-2.0"]), (10, "the rights to use are reserved by all of us"), (11, None)]
    found = collections.defaultdict(list)
    for r in licences.scan(frame(spark, rows)).orderBy("doc_id", "segment").collect():
        found[r.doc_id].append((r.segment, r.licence, r.dice))
    ids = {i: [(s, n) for s, n, _ in x] for i, x in found.items()}
    assert ids == {1: [(1, "Apache-2.0")], 2: [(0, "Apache-2.0")], 3: [(2, "MIT")], 4: [(1, "BSD-2-Clause")],
                   5: [(0, "BSD-3-Clause")], 6: [(0, "ISC")], 7: [(0, "Apache-2.0")], 8: [(0, "Unlicense")],
                   9: [(0, "LGPL-2.1"), (6, "EPL-2.0")]}
    assert all(d == 1 for x in found.values() for _, _, d in x)


def test_licence_sql(sf_dir, spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = sorted(tuple(r) for r in queries.op7_licence_scan(spark, sf_dir).collect())
    assert found == sorted(con.execute(queries.ORACLE["op7_licence_scan"]).fetchall())


def test_query_of_repeats(spark, sf_dir):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    kept = {r.doc_id: r.kept_sha256 for r in queries.op4_repeated_spans(spark, sf_dir).collect()}
    seen = set()
    for i in sorted(texts):
        words = words_of(texts[i])
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            if tuple(words[k:k + 20]) in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(tuple(words[k:k + 20]))
        assert kept[i] == hashlib.sha256(b" ".join(w for w, g in zip(words, gone) if not g)).hexdigest()

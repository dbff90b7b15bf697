"""Classifiers by held-out accuracy, the suffix tree by brute force and as a distribution."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import awkward, frame
from pyspark.sql import functions as F

from pressmill.llm import common, quality, queries, suffix_tree, toxicity
from pressmill.llm.common import crc_of_id


@pytest.fixture(scope="module")
def tenth(sf_dir):
    return sf_dir.replace("sf0.001", "sf0.01")


@pytest.mark.parametrize("name, label, modulus, rest", [
    ("op1_quality", "quality", 3, 1), ("op5_toxicity", "toxic", 5, 0)])
def test_held_out_accuracy(spark, tenth, name, label, modulus, rest):
    scored = queries.QUERIES[name](spark, tenth)
    assert scored.count() == queries.table(spark, tenth, "documents").count()
    rows = scored.join(queries.table(spark, tenth, "labels"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    right = {v: np.mean([r.predicted == v for r in held if r[label] == v]) for v in (0, 1)}
    assert min(right.values()) > 0.7 and np.mean([r.predicted == r[label] for r in held]) > 0.93


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_awkward_rows_and_labels(spark, module, label):
    docs = frame(spark, awkward() + [(None, "no id"), (10, "again"), (10, "again")])
    labels = spark.createDataFrame(
        [(10 + i, i % 2, "x") for i in range(12)] + [(10, 0, "x"), (None, 1, "x"), (11, None, "x"), (12, 7, "x"),
                                                     (300, 1, "x"), (301, 0, "x"), (9999, 1, "x")],
        f"doc_id bigint, {label} int, text string")
    for use in (F.lit(True), F.col("doc_id") < 0):
        model = module.fit(docs, labels, label, use)
        scores = module.score(docs, model).collect()
        assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert {round(r.score, 9) for r in scores} == {0.5}  # nothing to learn from
    none = frame(spark, [])
    assert module.score(none, module.fit(none, labels.where("false"), label, F.lit(True))).count() == 0
    by_text = collections.defaultdict(set)
    text = dict(awkward())
    for r in module.score(docs.where("doc_id >= 300"), model).collect():
        by_text[text[r.doc_id] or ""].add(r.score)
    assert all(len(v) == 1 for v in by_text.values())  # equal texts, equal scores


def damerau(a, b):
    """Edits with swaps of neighbours, each letter in one edit at most."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_equals_edit_distance():
    terms, stems = ("ape", "apes", "idiot", "moron", "worthless", "trashbin"), ("lowei", "chl")
    automaton = toxicity.Automaton(terms, stems)
    rng = np.random.default_rng(3)
    words = {"", "a", "lowe", "loweix", "chl", "chlx", "xchl", "idito", "dioit", "moorn", "worhtlses"}
    for term in terms:
        for _ in range(150):
            w = list(term)
            for _ in range(rng.integers(0, 4)):
                kind, at = rng.integers(0, 4), int(rng.integers(0, len(w) + 1))
                if kind == 0:
                    w.insert(at, "aeoixt"[rng.integers(0, 6)])
                elif at < len(w) and kind == 1:
                    del w[at]
                elif at < len(w) and kind == 2:
                    w[at] = "aeoixt"[rng.integers(0, 6)]
                elif at + 1 < len(w):
                    w[at], w[at + 1] = w[at + 1], w[at]
            words.add("".join(w))
    for word in words:
        least = min((damerau(word, t) for t in terms if damerau(word, t) <= toxicity.edits_allowed(len(t))),
                    default=None)
        expected = toxicity.STEM if word.startswith(stems) else \
            None if least is None else toxicity.EXACT if least == 0 else toxicity.NEAR
        assert automaton.match(word) == expected, word


def test_quotation_and_misspelling():
    model = toxicity.Model(("idiot", "worthless"), ("lowei",), frozenset({"idiom"}), ())
    matcher = toxicity.Matcher(model)
    texts = ["you idiot!", 'he wrote "you idiot" to me', "the word idiot is old", "you idoit", "an idiom", "Loweifoo",
             "", None, "« pauvre idiot » disait-elle", "It's an idiot's game, don't"]
    found = matcher.features(pa.array(texts))
    kinds = [np.flatnonzero(row[:4]).tolist() for row in found]
    exact, near, stem, quoted = [toxicity.EXACT], [toxicity.NEAR], [toxicity.STEM], [toxicity.QUOTED]
    assert kinds == [exact, quoted, quoted, near, [], stem, [], [], quoted, exact]


@pytest.mark.parametrize("rows", [awkward(), []])
def test_suffix_tree_counts(spark, rows):
    docs = frame(spark, rows + ([(None, "no id"), (10, "zzzz q"), (20, dict(rows)[20])] if rows else []))
    learn = crc_of_id() % 5 != 1
    found = {r.doc_id: r for r in suffix_tree.score(docs, learn, context_share=0.005).collect()}
    texts = dict(rows)
    if rows:
        texts[10] = min(texts[10], "zzzz q")
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in texts.items()}
    counts = collections.Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    total, normal = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    assert set(found) == set(tokens)
    for i, ws in tokens.items():
        base = sum(math.log10((counts[w] + 0.5) / normal) for w in ws)
        assert (found[i].n_tokens, found[i].n_known, found[i].train_tokens) == \
            (len(ws), sum(w in counts for w in ws), total)
        assert found[i].base_score == pytest.approx(base)


def suffix_tree_scores(tokens, learnt, depth=3, least=3, ratio=1.2):
    """Scores of ``tokens`` (id -> words and None) by all contexts of ``learnt`` that occur ``least`` times."""
    counts = collections.Counter(w for i in learnt for w in tokens[i])
    total = sum(counts.values())
    normal = total + 0.5 * (len(counts) + 1)
    after = collections.defaultdict(collections.Counter)
    for i in learnt:
        seen = (None, *tokens[i])
        for at in range(1, len(seen)):
            for length in range(1, min(depth, at) + 1):
                after[seen[at - length:at]][seen[at]] += 1
    kept, rest = {}, {}

    def p(ctx, word):
        if not ctx:
            return math.log10((counts[word] + 0.5) / normal)
        return kept[ctx][word] if word in kept.get(ctx, ()) else rest.get(ctx, 0) + p(ctx[1:], word)

    for ctx in sorted(after, key=len):
        size = after[ctx].total()
        own = {w: math.log10((n - 0.5) / size) for w, n in after[ctx].items() if n >= least}
        low = {w: p(ctx[1:], w) for w in own}
        own = {w: x for w, x in own.items() if abs(x - low[w]) >= math.log10(ratio)}
        if size < least or not own:
            continue
        other = math.log10((1 - sum(10 ** x for x in own.values())) / max(1e-12, 1 - sum(10 ** low[w] for w in own)))
        gain = sum(after[ctx][w] * (x - low[w]) for w, x in own.items()) \
            + (size - sum(after[ctx][w] for w in own)) * other
        if gain > 0.5 * math.log10(total) * len(own):
            kept[ctx], rest[ctx] = own, other
            every = sum(10 ** p(ctx, w) for w in counts) + 10 ** p(ctx, "of no text") if len(kept) % 9 == 0 else 1
            assert every == pytest.approx(1)  # a distribution
    scores = {i: sum(p((None, *ws)[max(0, at - depth):at], (None, *ws)[at]) for at in range(1, len(ws) + 1))
              for i, ws in tokens.items()}
    return scores, collections.Counter(map(len, kept)), collections.Counter(
        len(ctx) for ctx in kept if after[ctx].total() < 10)


def test_rare_contexts_score(spark):
    """A context of three occurrences counts, whatever the size of the corpus."""
    rows = awkward() + [(1000 + i, f"filler{i} " * 2000) for i in range(20)]  # 4e-4 of the tokens are 16 occurrences
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    learnt = [i for i in tokens if zlib.crc32(str(i).encode()) % 5 != 1]
    expected, lengths, rare = suffix_tree_scores(tokens, learnt)
    assert set(lengths) == {1, 2, 3} and rare.total() > 50
    found = suffix_tree.score(frame(spark, rows), crc_of_id() % 5 != 1).collect()
    assert {r.doc_id: r.score for r in found} == pytest.approx(expected)


def test_blobs_keep_what_they_pack():
    rng = np.random.default_rng(5)
    for size in (0, 1, 5, 3000):
        keys = np.unique(rng.integers(0, 1 << 60, size, np.uint64)) + np.uint64(1 << 62)
        assert (suffix_tree._unpack_keys(suffix_tree._pack_keys(keys, 1 << 62), 1 << 62) == keys).all()
        counts = rng.integers(0, 3, size) * rng.integers(1, 1 << 40, size)
        assert (suffix_tree._unpack_counts(suffix_tree._pack_counts(counts), size) == counts).all()
        flags = rng.integers(0, 2, size).astype(bool)
        assert (suffix_tree._unpack_flags(suffix_tree._pack_flags(flags), size) == flags).all()


@pytest.mark.parametrize("range_keys, slice_bytes", [(100, 2000), (5000, 1 << 20)])
def test_many_slices_and_ranges(spark, range_keys, slice_bytes, monkeypatch):
    """Scores do not depend on how texts and keys are cut."""
    rows = awkward() + [(1000 + i, "the cat sat on the mat and the dog sat on the rug " * (i % 4)) for i in range(60)]
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    expected = suffix_tree_scores(tokens, [i for i in tokens if zlib.crc32(str(i).encode()) % 5 != 1])[0]
    monkeypatch.setattr(suffix_tree, "RANGE_KEYS", range_keys)
    cut = suffix_tree.slices
    monkeypatch.setattr(suffix_tree, "slices", lambda batches: cut(batches, limit=slice_bytes))
    found = suffix_tree.score(frame(spark, rows), crc_of_id() % 5 != 1).collect()
    assert len(found) == len(expected) and {r.doc_id: r.score for r in found} == pytest.approx(expected)


@pytest.mark.parametrize("keys", [[], [7], [5, 5, 5], [3 << 40, 2, 1, 2, (3 << 40) + 1, 3 << 40, 2**64 - 1, 0]])
def test_keys_are_grouped_in_stable_order(keys):
    keys = np.array(keys, np.uint64)
    order, new = common.grouped(keys)
    assert order.tolist() == np.argsort(keys, kind="stable").tolist()
    assert keys[order[new]].tolist() == sorted(set(keys.tolist()))


def test_suffix_tree_portion_reads_its_own_files(spark):
    table = spark.range(64).select(F.col("id").alias("slice"), F.lit(b"x").alias("keys"))
    found = suffix_tree._in_portions(table, "sequences")
    assert found.count() == 64
    own = found.where(F.col("portion") == 3).select(F.input_file_name().alias("file"))
    assert all("/portion=3/" in row.file for row in own.collect())
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(portion" in plan


def test_suffix_tree_asks_less_in_longer_slices(spark):
    text = " ".join(f"w{i % 997}" for i in range(300_000))  # 1.5 MB each
    docs = spark.createDataFrame([(i, text, True) for i in range(2)], "doc_id bigint, text string, learnt boolean").coalesce(1)
    assert suffix_tree._sequences(docs).count() == 1


def test_suffix_tree_levels_are_computed_once(spark, monkeypatch):
    """Each length is one pass over its runs and one written table, not one for contexts and one for words."""
    rows = [(i, "the cat sat on the mat and the dog sat on the rug " * (i % 4)) for i in range(40)]
    tokens = {i: t.encode().split() + [None] for i, t in rows}
    written, write = [], suffix_tree.stage
    monkeypatch.setattr(suffix_tree, "stage", lambda df, name, by=(): (written.append(name), write(df, name, by))[1])
    found = suffix_tree.score(frame(spark, rows), crc_of_id() % 5 != 1).collect()
    expected = suffix_tree_scores(tokens, [i for i in tokens if zlib.crc32(str(i).encode()) % 5 != 1])[0]
    assert {r.doc_id: r.score for r in found} == pytest.approx(expected)
    assert written.count("level") == 3 and "contexts" not in written


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_suffix_tree_lists_of_a_range_share_a_blob(bits):
    rng = np.random.default_rng(bits)
    lists = [np.unique(rng.integers(0, 2**64 - 1, size, np.uint64, True)) for size in (40, 0, 300)]
    merged, places = suffix_tree._interleaved(lists, bits)
    assert all((merged[at] == keys).all() for at, keys in zip(places, lists))
    cuts = list(suffix_tree._cut(merged, bits))
    assert [part for part, *_ in cuts] == list(range(1 << bits))
    for part, start, a, b in cuts:
        assert not bits or (merged[a:b] >> np.uint64(64 - bits) == part).all()
        assert (suffix_tree._unpack_keys(suffix_tree._pack_keys(merged[a:b], start), start) == merged[a:b]).all()


@pytest.mark.parametrize("block", [1, 7, 64])
def test_word_hashes_do_not_depend_on_blocks(block, monkeypatch):
    words = common.Words(pa.array(["a bb  ccc", None, "", "dddddddddddddddddddd a bb", " x\t" * 30]))
    expected = [words.hashes(which) for which in (0, 1)]
    monkeypatch.setattr(common, "_BLOCK", block)
    assert all((words.hashes(which) == expected[which]).all() for which in (0, 1))
    at, code = words.distinct(words.hashes())
    assert [words.word(at[c]) for c in code] == [words.word(i) for i in range(len(words))]
    assert len(set(map(words.word, at))) == len(at)


def test_suffix_tree_beats_words(spark, tenth):
    rows = suffix_tree.score(queries.table(spark, tenth, "documents"), crc_of_id() % 5 != 1) \
        .where(crc_of_id() % 5 == 1).agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]

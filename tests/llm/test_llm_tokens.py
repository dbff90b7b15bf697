"""Byte-level BPE against tiktoken, packing against the tokenizers library."""

import base64
import collections
import hashlib
import struct
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import awkward, frame
from tokenizers import Tokenizer

from pressmill.llm import bpe, packing, queries

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encode_and_decode(spark, encoding):
    rows = awkward() + [(None, "no id"), (10, "same id again"), (10, "same id again")]
    encoded = bpe.encode(frame(spark, rows), RANKS, public_tokenizers.PATTERN)
    found = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    got = collections.Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in found)
    assert got == collections.Counter(
        (i, tuple(encoding.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=30), max_size=8))
def test_replay_equals_tiktoken(encoding, texts):
    vocabulary = bpe.Vocabulary.load(RANKS, public_tokenizers.PATTERN)
    flat, counts = vocabulary.encode(iter([texts]))
    assert flat.tolist() == [x for t in texts for x in encoding.encode_ordinary(t)]
    assert counts.tolist() == [len(encoding.encode_ordinary(t)) for t in texts]


def test_replay_where_a_merge_opens_a_lower_rank(tmp_path):
    path = tmp_path / "ranks"
    symbols = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"ab", b"aa", b"abcab"]
    path.write_bytes(b"\n".join(base64.b64encode(s) + b" %d" % i for i, s in enumerate(symbols)))
    own = tiktoken.Encoding("x", pat_str=r"\S+", mergeable_ranks={s: i for i, s in enumerate(symbols)},
                            special_tokens={})
    vocabulary = bpe.Vocabulary(str(path), r"\S+")
    words = ["abcbc", "ababcab", "aabcaab", "aaaaa", "abcabcab", "bcab", "aaaa", "caab"]
    flat, counts = vocabulary.encode(iter([words]))
    assert flat.tolist() == [x for w in words for x in own.encode_ordinary(w)]


def test_empty_tables(spark):
    none = frame(spark, [])
    assert bpe.decode(bpe.encode(none, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).count() == 0
    assert packing.pack(packing.pieces(none, WORDS, 2, 64), 64).count() == 0


@pytest.mark.parametrize("limit", [64, 4096])
def test_packing(spark, limit):
    rows = awkward()
    given_rows = rows + [(None, "no id"), (10, "zzzz"), (20, dict(rows)[20])]
    packed = packing.pack(packing.pieces(frame(spark, given_rows), WORDS, 2, limit, keep_ids=True), limit).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    expected = dict(rows)
    expected[10] = min(expected[10], "zzzz")
    pieces = collections.defaultdict(list)
    for r in packed:
        pieces[r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
    assert set(pieces) == set(expected)
    for doc, text in expected.items():
        own = sorted(pieces[doc], key=lambda r: r.start)
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert [x for r in own for x in r.ids] == ids
        assert [r.start for r in own] == [sum(p.length for p in own[:i]) for i in range(len(own))]
        assert {r.doc_tokens for r in own} == {len(ids)}
    sequences = collections.defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= limit


def test_shortest_pack_first():
    patterns = packing.shortest_pack_first({5: 3, 3: 4, 2: 1, 1: 7}, 8)
    placed = collections.Counter()
    for lengths, count in patterns:
        assert sum(lengths) <= 8 and list(lengths) == sorted(lengths, reverse=True)
        for length in lengths:
            placed[length] += count
    assert placed == {5: 3, 3: 4, 2: 1, 1: 7}
    assert sum(count for _, count in patterns) == 5
    assert packing.shortest_pack_first({}, 8) == []


def test_query_digests(spark, sf_dir, encoding):
    docs = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    for r in queries.op2_byte_bpe(spark, sf_dir).collect():
        ids = encoding.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_word_ids_of_all_code_points():
    """Every assigned code point alone, in a word, and between combining marks, as the library has it."""
    points = [chr(i) for i in range(0x21, 0x110000) if unicodedata.category(chr(i)) not in ("Cs", "Cn", "Co")]
    marks = [c for c in points if unicodedata.category(c).startswith("M")]
    newer = [chr(i) for i in (0x7FD, 0x898, 0x9FE, 0xC3C, 0x1ABF, 0x10EFD, 0x11F41, 0x1E08F)]
    letters = [c for c in points if len(c.encode()) < 4 and not "㐀" <= c <= "힣"]
    texts = ["ͅ" + c + "́" for c in marks + newer + letters[::7]]
    texts += [f"a{c}b" for c in letters] + ["e" + c + "̣x́" for c in marks]
    tokenizer = packing.WordTokenizer.load(WORDS)
    flat, counts = tokenizer.encode(pa.array(texts))
    ends = np.cumsum(counts)
    library = Tokenizer.from_file(WORDS).encode_batch_fast(texts, add_special_tokens=False)
    wrong = [t for t, a, b, x in zip(texts, ends - counts, ends, library) if flat[a:b].tolist() != x.ids]
    assert not wrong, wrong[:20]

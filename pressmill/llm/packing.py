"""Packing token sequences by shortest-pack-first over the length histogram.

1. Documents are tokenised and cut into pieces: whole sequences first, then the rest.
2. The histogram of piece lengths, at most as long as a sequence, goes to the driver.
   Lengths are placed longest first, each into the shortest open pack that has room,
   for all packs of one pattern at once; the result is a list of patterns with counts.
3. Every piece gets its rank among the pieces of its length, and that rank is looked
   up in the patterns: they say which sequence has the piece, and where.

Ranks are counted in small groups of pieces with offsets between the groups, so a
length that a third of the pieces share is not gathered in one task.

A null or empty text is a document of the end token alone. Of rows that repeat an
id the one with the least text counts, rows without id go, other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm.common import Words, documents, gather, one_per_id, slices, spans_of
from pressmill.session import materialize

#: Pieces of one length that are ranked together, about.
RANK_GROUP = 500
PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class _Codes(dict):
    """Numbers pieces in the order of their first use."""

    def __missing__(self, piece: str) -> int:
        self[piece] = code = len(self)
        return code


class WordTokenizer:
    """A word-level tokenizer of the ``tokenizers`` library, applied to distinct pieces of words.

    For a tokenizer that drops white space and never merges across pieces, whose
    tokens at the end of a piece carry a suffix. The library encodes the pieces of
    a slice of the corpus that are new, fifty in one text; the suffix tells where
    the ids of a piece end. Words with control or space characters or with special
    tokens are given to the library as they are.
    """

    _loaded: dict[str, WordTokenizer] = {}
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: Pieces that are remembered; beyond that all are forgotten.
    REMEMBERED = 200_000

    def __init__(self, path: str, suffix: str = "</w>") -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallel part
        from tokenizers import Tokenizer, pre_tokenizers

        self.path = path
        self.tokenizer = None  # made if a word needs it
        self.merges = Tokenizer.from_file(path)  # for pieces that are normalised and split
        self.merges.normalizer = None
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.merges.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.last[number] = token.endswith(suffix)
        self.split = regex.compile(self.PIECES + "|\n").findall
        self.marks = regex.compile(r"\p{M}").search
        self.special = [t.content for t in self.merges.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes({"\n": 0})
        self.starts, self.counts = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)

    @classmethod
    def load(cls, path: str) -> WordTokenizer:
        """One instance for each Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _whole(self, text: str) -> list[int]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, fresh: list[str]) -> None:
        """Encode pieces that have got their codes just now."""
        texts = [" ".join(fresh[i:i + 50]) for i in range(0, len(fresh), 50)]
        found = [x.ids for x in self.merges.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.int32)
        cuts = np.flatnonzero(self.last[ids]) + 1
        if len(cuts) != len(fresh) or cuts[-1] != len(ids):
            found = list(map(self._whole, fresh))
            ids = np.fromiter(chain.from_iterable(found), np.int32)
            cuts = np.cumsum([len(x) for x in found])
        counts = np.diff(np.append(0, cuts))
        self.starts = np.append(self.starts, cuts - counts + len(self.ids))
        self.counts = np.append(self.counts, counts)
        self.ids = np.append(self.ids, ids)

    def _odd(self, text: str) -> bool:
        """Whether a text has something that only the library itself handles for certain.

        Combining marks are composed by its own Unicode tables, which are of another age than Python's.
        """
        return not text.isprintable() or self.marks(text) is not None or any(mark in text for mark in self.special)

    def _words(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, of which each has a line, one after another, and how many each has."""
        if self._odd(text.replace("\n", "")):
            words = text.split("\n")
            odd = {i: self._whole(word) for i, word in enumerate(words) if self._odd(word)}
            plain = [word for i, word in enumerate(words) if i not in odd]
            ids, counts = self._words("\n".join(plain)) if plain else (np.zeros(0, np.int32), [])
            cuts = np.append(0, np.cumsum(counts)).astype(np.int64)
            rest = (ids[x:y] for x, y in zip(cuts, cuts[1:]))
            parts = [np.array(odd[i], np.int32) if i in odd else next(rest) for i in range(len(words))]
            return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        # lower case letter by letter, without the rule for a final sigma
        text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        words = text.split("\n")
        plain = np.fromiter(map(str.isalpha, words), bool, len(words))  # one piece each
        mixed = self.split("\n".join(compress(words, ~plain)))
        if len(self.codes) > self.REMEMBERED:
            self._forget()
        known = len(self.codes)
        code = self.codes.__getitem__
        single = np.fromiter(map(code, compress(words, plain)), np.int64)
        several = np.fromiter(map(code, mixed), np.int64, len(mixed))
        if len(self.codes) > known:
            self._learn(list(islice(self.codes, known, None)))
        ends = np.append(np.flatnonzero(several == 0), len(several))
        starts = np.append(0, ends[:-1] + 1)
        first, size = np.empty(len(words), np.int64), np.ones(len(words), np.int64)
        first[plain] = np.arange(len(single))
        if not plain.all():
            first[~plain], size[~plain] = starts + len(single), ends - starts
        codes = gather(np.append(single, several), first, size)
        sizes = self.counts[codes]
        summed = np.append(0, np.cumsum(sizes))
        return gather(self.ids, self.starts[codes], sizes), np.diff(summed[np.append(0, np.cumsum(size))])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        words = Words(column)
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(len(column), np.int64)
        at, code = words.distinct()
        flat, counts = self._words(words.lines(at))
        sizes, starts = counts[code], spans_of(counts)[0]
        summed = np.append(0, np.cumsum(sizes))
        return gather(flat, starts[code], sizes), np.diff(summed[words.first])


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, limit: int, keep_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``limit`` ids of every document, ``end_id`` being the last of each.

    Columns ``doc_id, start, length, ids_crc32, doc_tokens`` and on request ``ids``;
    the checksum is over the ids as unsigned little-endian 32-bit numbers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.load(tokenizer_path)
        for part in slices(batches):
            flat, counts = tokenizer.encode(part.column("text"))
            begins, ends = spans_of(counts)
            rows: list[tuple] = []
            kept = []
            for doc, a, b in zip(part.column("doc_id").to_pylist(), begins.tolist(), ends.tolist()):
                ids = np.append(flat[a:b], np.int32(end_id)).astype("<u4")
                for start in range(0, len(ids), limit):
                    piece = ids[start:start + limit]
                    rows.append((doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
                    if keep_ids:
                        kept.append(piece.astype(np.int32))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECE_SCHEMA + (", ids array<int>" if keep_ids else "")
    return one_per_id(documents(docs, id_col, text_col)).mapInArrow(run, schema)


def shortest_pack_first(histogram: dict[int, int], limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, each with how many sequences follow it."""
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    totals: list[int] = []
    full: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], count: int, total: int) -> None:
        if total == limit:
            full.append((pattern, count))
            return
        if total not in open_packs:
            open_packs[total] = []
            heapq.heappush(totals, total)
        open_packs[total].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not totals or totals[0] + length > limit:
                fit = limit // length  # new packs: no shorter one has room
                if left >= fit:
                    put((length,) * fit, left // fit, length * fit)
                if left % fit:
                    put((length,) * (left % fit), 1, length * (left % fit))
                break
            total = totals[0]
            pattern, count = open_packs[total].pop()
            if not open_packs[total]:
                del open_packs[total]
                heapq.heappop(totals)
            used = min(left, count)
            if count > used:
                put(pattern, count - used, total)
            put((*pattern, length), used, total + length)
            left -= used
    return full + list(chain.from_iterable(open_packs.values()))


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Per place in a pattern: length, first rank, first sequence, offset; by length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, count in patterns:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, offset))
            used[length] = rank + count
            offset += length
        sequence += count
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pack(pieces: DataFrame, limit: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``doc_id``, ``start`` and ``length``.

    Lengths are from 1 to ``limit``. Pieces of a sequence lie without gaps from
    offset 0. What goes to the driver and to every task is bounded by ``limit``:
    the histogram, and the patterns made from it.
    """
    pieces = materialize(pieces, "pieces")
    histogram = {row["length"]: row["n"] for row in
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(histogram.values())
    groups = F.array(*(F.lit(math.ceil(histogram.get(n, 0) / RANK_GROUP) or 1) for n in range(1, limit + 1)))
    pieces = pieces.withColumn("rank_group", F.pmod(
        F.xxhash64("doc_id", "start"), F.element_at(groups, F.col("length").cast("int"))))
    counts = materialize(pieces.groupBy("length", "rank_group").agg(F.count("*").alias("n")), "lengths")
    slots = _slots(shortest_pack_first(histogram, limit))
    before = counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("rank_group")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("length", "rank_group").orderBy("doc_id", "start"))
    ranked = pieces.withColumn("place", place - 1).join(before, ["length", "rank_group"]) \
        .withColumn("rank", F.col("before") + F.col("place")).drop("before", "place", "rank_group")
    key = slots[:, 0] * (total + 1) + slots[:, 1] if len(slots) else np.zeros(0, np.int64)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(key, length * (total + 1) + rank, side="right") - 1
            sequence = slots[at, 2] + rank - slots[at, 1]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(slots[at, 3])],
                [*names, "sequence_id", "offset"])

    columns = ", ".join(f"`{n}` {t}" for n, t in ranked.dtypes if n != "rank")
    return ranked.mapInArrow(look_up, f"{columns}, sequence_id bigint, offset bigint")

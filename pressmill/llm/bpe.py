"""Byte-level BPE by corpus-level merge replay.

The distinct words of a batch of the corpus are laid out byte by byte in one
sequence. An inverted index lists, for each merge rank, the positions whose
symbol and next symbol merge at that rank. Ranks are replayed from the lowest up,
each for all its positions at once; a merge touches its position and the two
neighbours, whose new pairs enter the index. A vocabulary may let a merge open a
pair of a lower rank; the few words where that happens are replayed one by one,
lowest rank first, then leftmost, as every word has to be.

Rows are independent of each other and nothing is shuffled. A null or empty text
has no ids; repeated rows and null ids give a row each; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pressmill.llm.common import as_texts, documents, slices, spans_of


#: Bytes of text whose words are replayed together.
BATCH_BYTES = 12 << 20
#: Texts decoded at a time.
DECODE_ROWS = 500


class _Codes(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


class Vocabulary:
    """Ranks of a rank file, ready for replay."""

    _loaded: dict[tuple[str, str], Vocabulary] = {}

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.split = regex.compile(pattern).findall
        self.size = max(self.ranks.values()) + 1
        self.symbols: list[bytes] = [b""] * self.size
        for symbol, rank in self.ranks.items():
            self.symbols[rank] = symbol
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}  # left * size + right -> rank of the merge
        for symbol, rank in self.ranks.items():
            for cut in range(1, len(symbol)):
                left, right = self.ranks.get(symbol[:cut]), self.ranks.get(symbol[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.pairs = pairs
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.fromiter(pairs.values(), np.int32, len(pairs))[order], np.int32(-1))

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        """One instance for each Python worker."""
        key = (path, pattern)
        if key not in cls._loaded:
            cls._loaded[key] = cls(path, pattern)
        return cls._loaded[key]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks at which two symbols merge, -1 for never."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], np.int32(-1))

    def _alone(self, word: bytes) -> list[int]:
        """One word, lowest rank first, then leftmost, from a queue of (rank, position)."""
        pairs, size = self.pairs, self.size
        symbol = self.single[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(symbol)), -1], list(range(-1, len(symbol) - 1))
        queue = [(pairs[key], i) for i in range(len(symbol) - 1)
                 if (key := symbol[i] * size + symbol[i + 1]) in pairs]
        heapq.heapify(queue)
        while queue:
            rank, left = heapq.heappop(queue)
            right = after[left]
            if symbol[left] < 0 or right < 0 or pairs.get(symbol[left] * size + symbol[right]) != rank:
                continue
            symbol[left], symbol[right] = rank, -1
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            for at in (before[left], left):
                if at >= 0 and after[at] >= 0:
                    new = pairs.get(symbol[at] * size + symbol[after[at]])
                    if new is not None:
                        heapq.heappush(queue, (new, at))
        return [x for x in symbol if x >= 0]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each word has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts, ends = spans_of(lengths)
        symbol = self.single[np.frombuffer(b"".join(words), np.uint8)]
        total = len(symbol)
        if not total:
            return np.zeros(0, np.int32), lengths
        after, before = np.arange(1, total + 1), np.arange(-1, total - 1)
        full = lengths > 0
        after[ends[full] - 1] = -1
        before[starts[full]] = -1
        joined = np.flatnonzero(after >= 0)
        rank_at = np.full(total, -1, np.int32)  # rank of the pair that begins here
        rank_at[joined] = self._rank(symbol[joined], symbol[joined + 1])
        joined = joined[rank_at[joined] >= 0]
        joined = joined[np.argsort(rank_at[joined], kind="stable")]
        ranks, first = np.unique(rank_at[joined], return_index=True)
        index: dict[int, list] = {r: [p] for r, p in zip(ranks.tolist(), np.split(joined, first[1:]))}
        heap = list(index)
        heapq.heapify(heap)
        out_of_order: set[int] = set()
        while heap:
            rank = heapq.heappop(heap)
            parts = index.pop(rank)
            left = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            left = left[rank_at[left] == rank]
            if not len(left):
                continue
            right = after[left]
            if len(left) > 1 and (chained := right[:-1] == left[1:]).any():
                # of touching pairs every other one merges, from the left
                run = np.arange(len(left))
                begin = np.maximum.accumulate(np.where(np.append(True, ~chained), run, 0))
                left = left[(run - begin) % 2 == 0]
                right = after[left]
            follower = after[right]
            symbol[left], symbol[right] = rank, -1
            rank_at[right] = -1
            after[left] = follower
            inner = follower >= 0
            before[follower[inner]] = left[inner]
            former = before[left]
            former = former[former >= 0]
            touched = np.concatenate([left, former])
            nexts = after[touched]
            new = np.where(nexts >= 0, self._rank(symbol[touched], symbol[nexts]), np.int32(-1))
            rank_at[touched] = new
            if (early := (new >= 0) & (new <= rank)).any():
                out_of_order.update(touched[early].tolist())
            use = new > rank
            touched, new = touched[use], new[use]
            order = np.argsort(new, kind="stable")
            touched, new = touched[order], new[order]
            cuts = np.flatnonzero(np.diff(new)) + 1
            for value, places in zip(new[np.append(0, cuts)].tolist() if len(new) else (),
                                     np.split(touched, cuts)):
                if value in index:
                    index[value].append(places)
                else:
                    index[value] = [places]
                    heapq.heappush(heap, value)
        alive = symbol >= 0
        counts = np.add.reduceat(np.append(alive, False), starts, dtype=np.int64) * full
        ids = symbol[alive]
        if out_of_order:
            at = np.array(sorted(out_of_order))
            ids = self._mend(words, ids, counts, np.unique(np.searchsorted(starts, at, "right") - 1))
        return ids, counts

    def _mend(self, words: list[bytes], ids: np.ndarray, counts: np.ndarray,
              which: np.ndarray) -> np.ndarray:
        """Replace the ids of some words by those of a replay of each; corrects ``counts``."""
        starts, ends = spans_of(counts)
        pieces, at = [], 0
        for word in which.tolist():
            pieces.append(ids[at:starts[word]])
            pieces.append(np.array(self._alone(words[word]), np.int32))
            at = ends[word]
        pieces.append(ids[at:])
        counts[which] = [len(x) for x in pieces[1::2]]
        return np.concatenate(pieces)

    def encode(self, parts: Iterator[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        codes = _Codes()
        seen, lengths = [], []
        for texts in parts:
            for text in texts:
                words = self.split(text)
                lengths.append(len(words))
                seen.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
        words = [word.encode() for word in codes]
        codes.clear()
        whole = np.fromiter((self.ranks.get(word, -1) for word in words), np.int32, len(words))
        ids, counts = self.replay([b"" if r >= 0 else w for w, r in zip(words, whole.tolist())])
        counts = np.where(whole >= 0, 1, counts)
        starts, ends = spans_of(counts)
        table = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        single = np.repeat(whole >= 0, counts)
        table[~single] = ids
        table[starts[whole >= 0]] = whole[whole >= 0]
        flat = np.concatenate(seen) if seen else np.zeros(0, np.int32)
        size = counts[flat]
        begin, end = spans_of(size)
        place = np.repeat(starts[flat] - begin, size) + np.arange(int(end[-1]) if len(end) else 0)
        summed = np.append(0, np.cumsum(size))
        bounds = np.append(0, np.cumsum(np.array(lengths, np.int64)))
        return table[place], np.diff(summed[bounds])


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>``: each match of ``pattern`` encoded by the ranks in the file.

    ``ranks_path`` must be readable on every executor, as an installed package's file is.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(ranks_path, pattern)
        for batch in slices(batches, limit=BATCH_BYTES):
            flat, counts = vocabulary.encode(as_texts(x.column("text")) for x in slices(iter([batch])))
            offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "ids"])

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded binary``, the bytes that ``ids`` stand for. A null list gives none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Vocabulary.load(ranks_path, pattern).symbols
        for batch in batches:
            for start in range(0, batch.num_rows, DECODE_ROWS):
                part = batch.slice(start, DECODE_ROWS)
                ids = part.column("ids")
                decoded = [b"".join(map(symbols.__getitem__, x.values.to_numpy().tolist()))
                           if x.is_valid else b"" for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, pa.array(decoded, pa.binary())],
                    ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id bigint, ids array<int>, decoded binary")

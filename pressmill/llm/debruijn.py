"""Removal of repeated spans by compaction of the de Bruijn graph of word windows.

Every window of ``window`` consecutive words is an edge between the sequences of
one word less. Neighbouring edges of a text that share their minimiser, the least
hash of the ``anchor``-word sequences inside, form a path without branches and are
compacted into one piece. Equal windows have equal minimisers, so:

1. pieces are grouped by minimiser and content; all but the first of a group, in the
   order of (id, start), repeat it whole;
2. of the first ones, those whose minimiser occurs in another piece are opened into
   their windows, and these are grouped in the same way;
3. what repeats carries the coordinates of its first occurrence. Per text these are
   chained into maximal spans, and the words they cover are removed.

Each task looks for repetition in its own slice first and sends on one row per
content, so a passage that a third of the texts share stays small. Windows are told
apart by 128 bits of hash; ``verify`` compares the words of spans with those at
their source coordinates.

A null text has no words. Of rows that repeat an id the one with the least text
counts, rows without id go; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm.common import Words, documents, inverse_powers, mix, one_per_id, powers, slices, stage

WINDOW = 20
ANCHOR = 6
_BASES = (0xA24BAED4963EE407, 0x9FB21C651E98DF25)
_ROWS = "k1 bigint, k2 bigint, doc_id bigint, place bigint, src_doc bigint, src_place bigint"
#: place = start * _WIDTH + number of windows
_WIDTH = 32


class _Hashed:
    """Hashes of word sequences of some texts."""

    def __init__(self, column: pa.Array) -> None:
        self.words = Words(column)
        self.first = self.words.first
        self.text = np.repeat(np.arange(len(column)), self.words.per_text())
        size = len(self.words)
        self.sums = []
        for kind, base in enumerate(_BASES):
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(self.words.hashes(kind) * powers(base, size), out=sums[1:])
            self.sums.append(sums)

    def spans(self, starts: np.ndarray, ends: np.ndarray, kind: int) -> np.ndarray:
        sums, base = self.sums[kind], _BASES[kind]
        h = (sums[ends] - sums[starts]) * inverse_powers(base, starts)
        return mix(h + (ends - starts).astype(np.uint64))

    def pieces(self, window: int, anchor: int) -> tuple[np.ndarray, ...]:
        """Minimiser, content hash, first word and number of windows of every piece."""
        size = len(self.words)
        last = self.first[1:][self.text] if size else np.zeros(0, np.int64)  # end of each word's text
        at = np.arange(size)
        valid = at + window <= last
        if not valid.any():
            empty = np.zeros(0, np.int64)
            return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
        value = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
        whole = np.flatnonzero(at + anchor <= last)
        value[whole] = self.spans(whole, whole + anchor, 0)
        place, width, wanted = at.copy(), 1, window - anchor + 1
        while width < wanted:  # least of ``width`` values from each place on, the left one of equals
            step = min(width, wanted - width)
            other, where = value[step:], place[step:]
            less = other < value[:-step]
            value, place = np.where(less, other, value[:-step]), np.where(less, where, place[:-step])
            width += step
        starts = np.flatnonzero(valid)
        least, spot = value[starts], place[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (spot[1:] != spot[:-1]) | (starts[1:] != starts[:-1] + 1)
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(starts)))
        first = starts[begin]
        return least[begin], self.spans(first, first + count + window - 1, 1), first, count


def _rows(k1: np.ndarray, k2: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Rows for grouping by (k1, k2): those that repeat another one of the same slice say so."""
    order = np.lexsort((place, doc, k2, k1))
    k1, k2, doc, place = k1[order], k2[order], doc[order], place[order]
    new = np.ones(len(k1), bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | \
        (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])
    leader = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    # repeated rows need no group: they are spread over all tasks
    k1 = np.where(new, k1, mix(doc.astype(np.uint64) * np.uint64(_BASES[0]) + place.astype(np.uint64)))
    k2 = np.where(new, k2, np.uint64(0))
    return pa.RecordBatch.from_arrays(
        [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(doc), pa.array(place),
         pa.array(doc[leader], mask=new), pa.array(place[leader], mask=new)],
        [part.split()[0] for part in _ROWS.split(", ")])


def _first_of_each(rows: DataFrame) -> DataFrame:
    """Adds the first row of the group to all others; ``src_doc`` is null for the first itself."""
    group = Window.partitionBy("k1", "k2").orderBy("doc_id", "place")
    first = F.first(F.struct("doc_id", "place")).over(group)
    is_first = (F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.place") == F.col("place"))
    known = F.col("src_doc").isNotNull()
    return rows.withColumn("first", first).select(
        "k1", "doc_id", "place",
        F.when(known, F.col("src_doc")).when(~is_first, F.col("first.doc_id")).alias("src_doc"),
        F.when(known, F.col("src_place")).when(~is_first, F.col("first.place")).alias("src_place"))


def _repeats(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """``doc_id, start, n, src_doc, src_start``: runs of n windows and where they occur first."""
    if not anchor <= window < anchor + _WIDTH - 1:
        raise ValueError("window - anchor is out of range")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashed = _Hashed(part.column("text"))
            least, content, first, count = hashed.pieces(window, anchor)
            text = hashed.text[first]
            doc = part.column("doc_id").to_numpy()[text]
            yield _rows(least, content, doc, (first - hashed.first[text]) * _WIDTH + count)

    pieces = stage(_first_of_each(docs.mapInArrow(cut, _ROWS)), "pieces")
    firsts = pieces.where("src_doc is null").select("k1", "doc_id", "place")
    shared = firsts.groupBy("k1").agg(F.count("*").alias("n")).where("n > 1").select("k1")
    opened = stage(firsts.join(shared, "k1", "left_semi").groupBy("doc_id").agg(
        F.collect_list("place").alias("places")), "opened")

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashed = _Hashed(part.column("text"))
            places = part.column("places")
            place = places.flatten().to_numpy()
            text = np.repeat(np.arange(part.num_rows), places.value_lengths().to_numpy())
            count = place % _WIDTH
            inside = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            start = np.repeat(place // _WIDTH, count) + inside
            text = np.repeat(text, count)
            at = start + hashed.first[text]
            yield _rows(hashed.spans(at, at + window, 0), hashed.spans(at, at + window, 1),
                        part.column("doc_id").to_numpy()[text], start * _WIDTH + 1)

    windows = stage(_first_of_each(docs.join(opened, "doc_id").mapInArrow(open_, _ROWS))
                    .where("src_doc is not null"), "windows")
    return pieces.where("src_doc is not null").unionByName(windows).select(
        "doc_id", F.expr(f"place div {_WIDTH}").alias("start"), F.expr(f"place % {_WIDTH}").alias("n"),
        "src_doc", F.expr(f"src_place div {_WIDTH}").alias("src_start"))


def _chain(start: np.ndarray, length: np.ndarray, doc: np.ndarray, source: np.ndarray) -> list[tuple]:
    """Maximal spans of one text: overlapping ones whose sources lie as far apart as they do."""
    order = np.lexsort((start, start - source, doc))
    spans: list[list[int]] = []
    for i in order.tolist():
        a, b, d, s = int(start[i]), int(start[i] + length[i]), int(doc[i]), int(source[i])
        if spans and spans[-1][2] == d and spans[-1][0] - spans[-1][3] == a - s and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b, d, s])
    return sorted((a, b - a, d, s) for a, b, d, s in spans)


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, spans: bool = False,
                   id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: each text without the words that repeat earlier ones.

    A word goes if a window over it has the words of a window that starts earlier, in
    a text with a smaller id or in the same text. Windows are those of the input. The
    kept words are joined by one space. With ``spans`` there is also an array of
    structs ``start, length, source_doc, source_start``, in words. The columns named in
    ``carry``, ``text`` for the given one, are handed on.
    """
    docs = one_per_id(documents(docs, id_col, text_col, tuple(c for c in carry if c != "text")))
    found = _repeats(docs.select("doc_id", "text"), window, anchor).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "n", "src_doc", "src_start")).alias("found"))
    kind = pa.struct([(name, pa.int64()) for name in ("start", "length", "source_doc", "source_start")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = Words(part.column("text"))
            runs = part.column("found")
            flat = runs.flatten()
            sizes = runs.value_lengths().fill_null(0).to_numpy()
            text = np.repeat(np.arange(part.num_rows), sizes)
            start, count, source, at = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, start + words.first[text], 1)
            np.add.at(change, start + count + window - 1 + words.first[text], -1)
            keep = np.cumsum(change)[:-1] == 0
            removed = np.bincount(np.searchsorted(words.first, np.flatnonzero(~keep), "right") - 1,
                                  minlength=part.num_rows)
            per_text = words.per_text()
            kept_sums = np.append(0, np.cumsum(per_text - removed))
            lines = words.lines(np.flatnonzero(keep)).replace("\n", " ")
            # the texts lie one after another, a space after each word
            sizes_of = (words.ends - words.starts)[keep] + 1
            raw, bounds = lines.encode(), np.append(0, np.cumsum(sizes_of))[kept_sums]
            kept = [raw[a:max(a, b - 1)] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
            columns = [part.column("doc_id"), pa.array(per_text.astype(np.int64)),
                       pa.array(removed.astype(np.int64)), pa.array(kept, pa.binary()).cast(pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept"]
            if spans:
                cuts = np.append(0, np.cumsum(sizes))
                rows = [[dict(zip(("start", "length", "source_doc", "source_start"), span))
                         for span in _chain(start[a:b], count[a:b] + window - 1, source[a:b], at[a:b])]
                        for a, b in zip(cuts, cuts[1:])]
                columns.append(pa.array(rows, pa.list_(kind)))
                names.append("spans")
            yield pa.RecordBatch.from_arrays([*columns, *map(part.column, carry)], [*names, *carry])

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    if spans:
        schema += ", spans array<struct<start: bigint, length: bigint, source_doc: bigint, source_start: bigint>>"
    types = dict(docs.dtypes)
    schema += "".join(f", `{name}` {types[name]}" for name in carry)
    return docs.join(found, "doc_id", "left").mapInArrow(cut, schema)


def verify(docs: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Spans of ``remove_repeats(..., spans=True)`` whose words differ from those at their source."""
    split = F.split(F.regexp_replace(F.regexp_replace(
        "text", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""), r"[\x20\x09-\x0D]+", " "), " ")
    words = documents(docs).select("doc_id", split.alias("words"))
    spans = cleaned.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")
    source = words.select(F.col("doc_id").alias("source_doc"), F.col("words").alias("source_words"))
    return spans.join(words, "doc_id").join(source, "source_doc").where(
        F.slice("words", F.col("start").cast("int") + 1, F.col("length").cast("int"))
        != F.slice("source_words", F.col("source_start").cast("int") + 1, F.col("length").cast("int"))) \
        .select("doc_id", "start", "length", "source_doc", "source_start")

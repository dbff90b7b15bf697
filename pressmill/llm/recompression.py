"""Periodic runs of words, found with a grammar made by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) and a length of at least ``max(shortest, exponent * q)`` that no neighbouring
word extends.

*Candidates.* For each period p the positions 0, p, 2p, ... form a grid; over all p these
are in the order of n log n positions. A run of period p and exponent e holds e or more
grid positions one after another, or e - 1 and one step, so its words at e consecutive
multiples of p are equal. Positions where they are not are left out; this loses nothing.

*Grammar.* The words of the texts that have candidates, with a separator of its own after
each text, are compressed in rounds. A block round replaces a maximal block of one symbol
by a symbol that stands for (symbol, count); a pair round divides the symbols into
left and right ones and replaces each left-right pair by one symbol. The rounds end
when nothing is left to replace, after a number in the order of log n. Equal stretches
are parsed alike but for a few symbols at their ends.

*Extension.* The longest common extension of two positions climbs the levels of the
grammar for as long as both positions begin symbols of the next level, compares symbols
(within a block: counts) and, at a difference, goes down to the words. All queries
of a round go through the levels together. To the left it works the same on the
grammar of the reversed words. The two extensions of a candidate are the exact
bounds of its stretch of period p; of equal stretches the one of smallest p is a run.

Everything happens inside map tasks: no shuffle, and a task holds about 2 MB of text at a
time, or one text if that is longer.

Defined results: each row gives one row, also one without id or with a repeated one. A null
or empty text has no words, no runs and collapses to the empty string. Other columns are
ignored unless ``carry`` names them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import Words, documents, gather, mix, slices, spans_of

#: Candidates that are extended at a time.
_QUERIES = 100_000


def _number(a: np.ndarray, b: np.ndarray, first: int) -> tuple[np.ndarray, int]:
    """Symbols from ``first`` on for the distinct pairs of two arrays, and the next free one."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    out = np.empty(len(order), np.int64)
    out[order] = first + np.cumsum(new) - 1
    return out, first + int(new.sum())


class Grammar:
    """A run-length grammar of one sequence, level by level.

    A level is ``(symbol, start, blocks)``: its symbols, the word position each begins at (and
    the end of the sequence), and whether the next level replaced blocks, not pairs.
    Extensions need a last word that occurs once.
    """

    def __init__(self, words: np.ndarray) -> None:
        symbol, start = words.astype(np.int64), np.arange(len(words), dtype=np.int64)
        unused = int(symbol.max(initial=-1)) + 1
        self.levels = []
        salt = idle = 0
        while len(symbol) > 1 and idle < 16:
            before = len(symbol)
            for blocks in (True, False):
                keep, named, after = self._blocks(symbol, unused) if blocks else self._pairs(symbol, unused, salt)
                if len(keep) < len(symbol):
                    self.levels.append((symbol, np.append(start, len(words)), blocks))
                    symbol, start, unused = named, start[keep], after
            salt, idle = salt + 1, 0 if len(symbol) < before else idle + 1
        self.levels.append((symbol, np.append(start, len(words)), False))

    @staticmethod
    def _blocks(symbol: np.ndarray, unused: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Where maximal blocks of one symbol begin, and a symbol for each."""
        first = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
        count = np.diff(np.append(first, len(symbol)))
        named, many = symbol[first], count > 1
        if many.any():
            named[many], unused = _number(named[many], count[many], unused)
        return first, named, unused

    @staticmethod
    def _pairs(symbol: np.ndarray, unused: int, salt: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Symbols and left-right pairs of them; which symbols are left ones depends on ``salt``."""
        left = mix(symbol.astype(np.uint64) + np.uint64(salt << 40)) & np.uint64(1) == 0
        at = np.flatnonzero(left[:-1] & ~left[1:])
        named, keep = symbol.copy(), np.ones(len(symbol), bool)
        if len(at):
            named[at], unused = _number(symbol[at], symbol[at + 1], unused)
            keep[at + 1] = False
        keep = np.flatnonzero(keep)
        return keep, named[keep], unused

    def _compare(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether the symbols that begin at ``a`` and ``b`` are equal, and what follows them.

        Of two blocks of one symbol as much is passed over as both have.
        """
        symbol, start, blocks = self.levels[level]
        i, j = (np.searchsorted(start, x, side="right") - 1 for x in (a, b))
        same = symbol[i] == symbol[j]
        if not blocks:
            return same, start[i + 1], start[j + 1]
        above = self.levels[level + 1][1]
        left = np.minimum(*(above[np.searchsorted(above, x, side="right")] - x for x in (a, b)))
        return same, a + left, b + left

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` on, for arrays of unequal positions."""
        begin, a, b = a, a.astype(np.int64), b.astype(np.int64)
        differ = np.zeros(len(a), np.int64)  # the level at which two symbols were found to differ
        live = np.arange(len(a))
        for level in range(len(self.levels)):
            top, up = level + 1 == len(self.levels), []
            while len(live):
                if not top:
                    above = self.levels[level + 1][1]
                    climb = np.ones(len(live), bool)
                    for x in (a[live], b[live]):
                        climb &= above[np.searchsorted(above, x, side="right") - 1] == x
                    up.append(live[climb])
                    live = live[~climb]
                same, next_a, next_b = self._compare(level, a[live], b[live])
                differ[live[~same]] = level
                live = live[same]
                a[live], b[live] = next_a[same], next_b[same]
            live = np.concatenate(up) if up else live
            if not len(live):
                break
        for level in range(int(differ.max(initial=0)) - 1, -1, -1):
            live = np.flatnonzero(differ > level)
            while len(live):
                same, next_a, next_b = self._compare(level, a[live], b[live])
                live = live[same]
                a[live], b[live] = next_a[same], next_b[same]
        return a - begin


def _candidates(words: np.ndarray, text: np.ndarray, longest: int, exponent: int) -> Iterator[tuple[np.ndarray, int]]:
    """Grid positions of each period whose words at ``exponent`` consecutive multiples are equal.

    ``text`` says which text a word belongs to; ``longest`` is the length of the longest one.
    """
    for period in range(1, longest // exponent + 1):
        grid = words[::period]
        equal = grid[1:] == grid[:-1]
        found = equal[:len(equal) - exponent + 2].copy()
        for step in range(1, exponent - 1):
            found &= equal[step:len(equal) - exponent + 2 + step]
        at = np.flatnonzero(found) * period
        at = at[text[at] == text[at + (exponent - 1) * period]]
        if len(at):
            yield at, period


def runs_of(words: np.ndarray, sizes: np.ndarray, shortest: int = 6, exponent: int = 4) -> tuple[np.ndarray, ...]:
    """``text, start, length, period`` of all runs, by text, start and period.

    ``words`` are the word numbers (from 0) of texts one after another, ``sizes`` their lengths.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period twice or more")
    text = np.repeat(np.arange(len(sizes)), sizes)
    nothing = (np.zeros(0, np.int64),) * 4
    held = list(_candidates(words, text, int(sizes.max(initial=0)), exponent))
    if not held:
        return nothing
    at = np.concatenate([a for a, _ in held])
    period = np.repeat(np.array([p for _, p in held], np.int64), [len(a) for a, _ in held])
    # the grammars hold texts with candidates only: a separator of its own before and after each
    used, number = np.unique(text[at], return_inverse=True)
    begin, _ = spans_of(sizes)
    base, _ = spans_of(sizes[used] + 1)
    base = base + 1
    total = int((sizes[used] + 1).sum()) + 1
    line = np.full(total, -1, np.int64)
    inner = np.ones(total, bool)
    inner[0] = inner[base + sizes[used]] = False
    line[inner] = gather(words, begin[used], sizes[used])
    line[~inner] = int(words.max(initial=0)) + 1 + np.arange(int((~inner).sum()))
    right, left = Grammar(line), Grammar(line[::-1])
    at = at - begin[used][number] + base[number]
    # consecutive candidates of a period; those inside one stretch need one extension
    joins = np.append(False, (period[1:] == period[:-1]) & (at[1:] - at[:-1] == period[1:]))
    head = np.flatnonzero(~joins)
    stop = np.append(head[1:], len(at))
    found = []
    while len(head):
        after = np.zeros(len(head), np.int64)
        for i in range(0, len(head), _QUERIES):
            some = slice(i, i + _QUERIES)
            x, p = at[head[some]], period[head[some]]
            end = x + p + right.extension(x, x + p)
            start = x - left.extension(total - x, total - x - p)
            good = end - start >= np.maximum(shortest, exponent * p)
            found.append(np.column_stack([number[head[some]], start, end, p])[good])
            after[some] = head[some] + np.maximum(1, -((p + x - end) // p))
        more = after < stop
        head, stop = after[more], stop[more]
    rows = np.concatenate(found)
    rows = rows[np.lexsort(rows.T[::-1])]
    first = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)) if len(rows) else np.zeros(0, bool)
    which, start, end, period = rows[first].T
    order = np.lexsort((period, start, which))
    which, start, end, period = which[order], start[order], end[order], period[order]
    return used[which], start - base[which], end - start, period


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6,
                  exponent: int = 4, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` and ``carry`` of every row.

    ``runs`` has ``start`` (number of a word, from 0), ``length`` and ``period`` of each run, by
    start and period. ``collapsed`` has the words, joined by one space, that no run contains
    after its first ``period`` words.
    """
    kind = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"))
            _, code = words.distinct()
            sizes = words.per_text()
            text, start, length, period = runs_of(code, sizes, shortest, exponent)
            step = np.zeros(len(words) + 1, np.int64)  # how many runs drop a word, by differences
            np.add.at(step, words.first[text] + start + period, 1)
            np.add.at(step, words.first[text] + start + length, -1)
            kept = np.cumsum(step[:-1]) == 0
            offsets = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(kind)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), runs, _joined(words, kept),
                 *(batch.column(name) for name in carry)], ["doc_id", "n_words", "runs", "collapsed", *carry])

    rows = documents(docs, id_col, text_col, carry)
    more = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(find, "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,"
                                 f"period:bigint>>, collapsed string{more}")


def _joined(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    which = np.flatnonzero(kept)
    sizes = (words.ends - words.starts)[which] + 1
    data = gather(np.append(words.data, np.uint8(32)), words.starts[which], sizes)
    ends = np.cumsum(sizes)
    data[ends - 1] = 32
    count = np.searchsorted(which, words.first)
    bounds = np.append(0, ends)[count]
    # the space after the last word of a text is left out
    last = np.zeros(len(data), bool)
    last[bounds[1:][np.diff(count) > 0] - 1] = True
    lengths = np.diff(bounds) - (np.diff(count) > 0)
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(data[~last]))


def strongest(runs: str = "runs") -> Column:
    """The run of greatest length / period, compared exactly; of equal ones the least start, then period."""
    def before(x: Column, y: Column) -> Column:
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return F.when(a != b, F.when(a > b, -1).otherwise(1)).when(
            x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1)) \
            .otherwise(F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))

    return F.get(F.array_sort(runs, before), F.lit(0))

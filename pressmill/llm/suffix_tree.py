"""Language-model scores from a probabilistic suffix tree.

Symbols are lower-cased words and one end per text. The root is the smoothed
distribution of all words of the training texts. Below it stand contexts of one
to ``depth`` words. A context of at least ``least`` occurrences keeps the next words
that follow it ``least`` times or more and whose share differs from that in its
suffix, the shorter context, by ``ratio``; it is retained only if the divergence of
the two distributions, in nats over all its occurrences, pays for those words at half
the logarithm of the corpus size each. What it keeps is smoothed by a discount; the
rest of its probability goes to the suffix's other words in proportion. A text is
scored word by word from the longest retained context.

Counts are absolute, so the tree grows with the corpus; it is held in written tables
keyed by a 64-bit hash of the words. Texts are cut into slices of some megabytes. Each
slice asks for its runs of one and two words: their keys, sorted by length and key, go as one blob to each
range of keys, with what the slice counted. The range adds up and answers in the order
asked, so an answer has no keys. Longer runs are asked for in a second round, and only
where every pair of neighbours in them occurs ``least`` times, as else the run can't. One
slice of those that hold a run, named in the answer, reports it for the tree, with its
context and suffix. The score of a token is a sum over the runs that end with it (see
``context_tables``); what each run adds is asked for in the same way, by those runs alone
that can be in the tree, for one portion of the slices after another, which bounds what
lies on disk at a time; the tables of the slices are written in a folder per portion, so that each is read
by its own portion alone. Ranges are as many as the runs
need, so one holds about ``RANGE_KEYS`` at every size of the corpus; a run is in a
slice's question once, however often it occurs there.

A null or empty text is one end. Of rows that repeat an id the one with the least
text counts, rows without id go; other columns are ignored. Without training texts
every word has the same probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm import common
from pressmill.llm.common import Words, documents, grouped, mix, numbered, one_per_id, stage

DISCOUNT = 0.5
#: Keys, about, that a range of them has to add up at a time.
RANGE_KEYS = 2_000_000
#: Portions of the slices that are scored one after another.
PORTIONS = 8
#: Slices of twice the usual size: a run is asked for once in each.
slices = partial(common.slices, limit=2 * common.SLICE_BYTES)
#: Hash of the end; no word has it in practice.
_END = np.uint64(0)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CODEC = pa.Codec("zstd", 1)
_SEQUENCE = "slice bigint, doc_ids array<bigint>, sizes array<int>, learnt array<boolean>, words binary, " \
            "codes binary, symbols bigint"
_TOTALS = "slice bigint, part bigint, round int, counts binary, named binary"
_GRAMS = "length bigint, gram bigint, ctx bigint, shorter bigint, n bigint, total bigint, under bigint"


def _pack_keys(keys: np.ndarray, start: int) -> bytes:
    """Keys from ``start`` on as six bytes of each difference (four of all, then two), larger ones apart.

    Differences are taken modulo 2**64, so keys may be several sorted lists one after another.
    """
    gaps = np.diff(keys, prepend=np.uint64(start))
    high = (gaps >> np.uint64(48)).astype(np.uint16)
    large = np.flatnonzero(high).astype(np.uint32)
    return b"".join([np.uint32(len(keys)).tobytes(), gaps.astype(np.uint32).tobytes(),
                     (gaps >> np.uint64(32)).astype(np.uint16).tobytes(), large.tobytes(), high[large].tobytes()])


def _unpack_keys(blob: bytes, start: int) -> np.ndarray:
    n = int(np.frombuffer(blob, np.uint32, 1)[0])
    gaps = np.frombuffer(blob, np.uint16, n, 4 + 4 * n).astype(np.uint64)
    gaps <<= np.uint64(32)
    gaps |= np.frombuffer(blob, np.uint32, n, 4)
    apart = (len(blob) - 4 - 6 * n) // 6
    if apart:
        large = np.frombuffer(blob, np.uint32, apart, 4 + 6 * n)
        gaps[large] += np.frombuffer(blob, np.uint16, apart, 4 + 6 * n + 4 * apart).astype(np.uint64) << np.uint64(48)
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(start)


def _press(data: bytes) -> bytes:
    """Their number, then the bytes compressed."""
    return np.uint32(len(data)).tobytes() + _CODEC.compress(data, asbytes=True)


def _unpress(blob: bytes) -> bytes:
    return _CODEC.decompress(memoryview(blob)[4:], int(np.frombuffer(blob, np.uint32, 1)[0]), asbytes=True)


def _pack_counts(counts: np.ndarray) -> bytes:
    """One byte each and eight more for those of 255 or above, compressed."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return _press(small.tobytes() + counts[small == 255].astype(np.int64).tobytes())


def _unpack_counts(blob: bytes, size: int) -> np.ndarray:
    blob = _unpress(blob)
    counts = np.frombuffer(blob, np.uint8, size).astype(np.int64)
    counts[counts == 255] = np.frombuffer(blob, np.int64, (len(blob) - size) // 8, size)
    return counts


def _pack_flags(flags: np.ndarray) -> bytes:
    return _press(np.packbits(flags).tobytes())


def _unpack_flags(blob: bytes, size: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(_unpress(blob), np.uint8), count=size).astype(bool)


def _pack_codes(code: np.ndarray, distinct: int) -> bytes:
    """Numbers below ``distinct``, the first bytes of all, then the second bytes, ..., compressed."""
    width = max(1, (max(1, distinct - 1).bit_length() + 7) // 8)
    planes = code.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T
    return bytes([width]) + _press(planes.tobytes())


def _unpack_codes(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpress(blob[1:]), np.uint8).reshape(blob[0], -1)
    code = planes[-1].astype(np.int64)
    for plane in planes[-2::-1]:
        code <<= 8
        code |= plane
    return code


def _sequences(docs: DataFrame) -> DataFrame:
    """Texts (``doc_id, text, learnt``) as a row per slice: its distinct words and the order they come in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches):
            words = Words(part.column("text"), lower=True)
            hashes = words.hashes()
            at, code = words.distinct(hashes)
            sizes = words.per_text().astype(np.int32)
            # frequent words have low numbers, which compress
            order = np.argsort(-np.bincount(code, minlength=len(at)), kind="stable")
            rank = np.empty(len(at), np.int64)
            rank[order] = np.arange(len(at))
            row = [number, part.column("doc_id").to_pylist(), sizes.tolist(), part.column("learnt").to_pylist(),
                   hashes[at[order]].tobytes(), _pack_codes(rank[code], len(at)), int(sizes.sum()) + len(sizes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], kind) for x, kind in zip(row, (
                    pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.binary(),
                    pa.binary(), pa.int64()))],
                ["slice", "doc_ids", "sizes", "learnt", "words", "codes", "symbols"])
            number += 1

    return docs.mapInArrow(run, _SEQUENCE)


def _interleaved(lists: list[np.ndarray], bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted lists of keys as one, by range of keys and in a range by list, and the place of each key in it."""
    starts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    sizes = np.array([np.diff(np.searchsorted(keys, starts), prepend=0, append=len(keys)) for keys in lists])
    begins = (np.cumsum(sizes.T).reshape(sizes.T.shape) - sizes.T).T  # of each list in each range
    merged, places = np.empty(sum(map(len, lists)), np.uint64), []
    for keys, size, begin in zip(lists, sizes, begins):
        places.append(np.arange(len(keys)) + np.repeat(begin - (np.cumsum(size) - size), size))
        merged[places[-1]] = keys
    return merged, places


class _Slice:
    """The symbols of some texts, an end before each, its words, an end after, and the keys of their runs.

    ``keys`` has the keys of each round by range (in the first round single words of a range before
    pairs, each sorted, in the second sorted), ``number`` by length, for each symbol, the run that
    ends with it: its place in the keys of all rounds, -1 for none; ``single`` those of single words.
    """

    def __init__(self, row: dict, longest: int, bits: int) -> None:
        self.doc_ids, per_text, self.longest = row["doc_ids"], np.array(row["sizes"], np.int64), longest
        sizes = per_text + 2
        starts = np.cumsum(sizes) - sizes
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(len(self.text)) - np.repeat(starts, sizes)  # in its text
        self.last = np.zeros(len(self.text), bool)
        self.last[starts + sizes - 1] = True
        self.learnt = np.repeat(np.array(row["learnt"], bool), sizes)
        words = np.append(np.frombuffer(row["words"], np.uint64), _END)
        code = np.full(len(self.text), len(words) - 1)
        if per_text.any():
            code[(self.place > 0) & ~self.last] = _unpack_codes(row["codes"])
        self._symbol, hashes = words[code], mix(words + _STEP)
        # distinct words are sorted before they are dealt to their symbols, pairs at their symbols
        order, new, single = numbered(hashes)
        lists = [single]
        first = np.empty(len(words), np.int64)
        first[order] = np.cumsum(new) - 1
        if longest > 1:
            at = np.flatnonzero(self.place >= 1)
            self._hash = np.zeros(len(code), np.uint64)
            self._hash[at] = pairs = self._extended(hashes[code], at, 1)
            order, new, pairs = numbered(pairs)
            lists.append(pairs)
        keys, places = _interleaved(lists, bits)
        self.keys, self.number, self.single = [keys], [places[0][first][code]], places[0]
        if longest > 1:
            number = np.empty(len(at), np.int64)
            number[order] = places[1][np.cumsum(new) - 1]
            self.number.append(self._dealt(at, number))

    def _extended(self, hashes: np.ndarray, at: np.ndarray, back: int) -> np.ndarray:
        """Keys of the runs that end at some symbols, one word longer than those that ``hashes`` has for all."""
        return mix(hashes[at] * _STEP + self._symbol[at - back] + np.uint64(back))

    def _dealt(self, at: np.ndarray, number: np.ndarray) -> np.ndarray:
        found = np.full(len(self.text), -1)
        found[at] = number
        return found

    def add_longer(self, frequent: np.ndarray) -> None:
        """The second round; ``frequent`` tells which runs of the first can be part of longer ones."""
        use, ends, hashes = (self.place >= 1) & frequent[self.number[1]], [], []
        for length in range(3, self.longest + 1):
            use = use & np.append(False, use[:-1]) & (self.place >= length - 1)
            ends.append(np.flatnonzero(use))
            hashes.append(self._extended(self._hash, ends[-1], length - 1))
            self._hash[ends[-1]] = hashes[-1]
        keys = np.concatenate(hashes or [np.zeros(0, np.uint64)])
        order, new, keys = numbered(keys)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1 + len(self.keys[0])
        self.keys.append(keys)
        for at in ends:
            self.number.append(self._dealt(at, number[:len(at)]))
            number = number[len(at):]

    def counts(self, round_: int) -> np.ndarray:
        """How often each run of a round occurs in the texts to learn from."""
        first, size = sum(map(len, self.keys[:round_])), len(self.keys[round_])
        n = np.zeros(size, np.int64)
        for number in self.number[:2] if round_ == 0 else self.number[2:]:
            n += np.bincount(number[self.learnt & (self.place > 0) & (number >= 0)] - first, minlength=size)
        return n

    def answered(self, rows: list[dict], bits: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts of all runs, and which of them this slice is named for; adds the second round."""
        found = []
        for round_ in (0, 1):
            if round_:
                self.add_longer(found[0][0] >= least)
            cuts = list(_cut(self.keys[round_], bits))
            of = {row["part"]: row for row in rows if row["round"] == round_ and row["counts"] is not None}
            found.append([np.concatenate([np.zeros(0, kind), *(
                unpack(of[part][name], b - a) for part, _, a, b in cuts)])
                for name, unpack, kind in (("counts", _unpack_counts, np.int64), ("named", _unpack_flags, bool))])
            if not round_ and not any(row["round"] for row in rows):
                break
        return tuple(np.concatenate(x) for x in zip(*found))


def _cut(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int, int]]:
    """Of keys in the order of their ranges those ranges: its number, its first possible key, from where, to where."""
    if not len(keys):
        return
    if not bits:
        yield 0, 0, 0, len(keys)
        return
    part = keys >> np.uint64(64 - bits)
    at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(keys)]):
        yield int(part[a]), int(part[a]) << (64 - bits), a, b


_ASKED = pa.schema([("slice", pa.int64()), ("part", pa.int64()), ("round", pa.int32()), ("keys", pa.binary()),
                    ("counts", pa.binary())])
_ASKED_SQL = "slice bigint, part bigint, round int, keys binary, counts binary"


def _questions(own: _Slice, number: int, bits: int, round_: int) -> pa.Table:
    keys, counts = own.keys[round_], own.counts(round_)
    return pa.Table.from_pylist(
        [{"slice": number, "part": part, "round": round_, "keys": _pack_keys(keys[a:b], start),
          "counts": _pack_counts(counts[a:b])} for part, start, a, b in _cut(keys, bits)], _ASKED)


def _asked(sequences: DataFrame, longest: int, bits: int) -> DataFrame:
    """``slice, part, round, keys, counts``: what each slice asks of each range of keys first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from _questions(_Slice(row, min(2, longest), bits), row["slice"], bits, 0).to_batches()

    return sequences.mapInArrow(run, _ASKED_SQL)


def _asked_longer(sequences: DataFrame, totals: DataFrame, longest: int, bits: int, least: int) -> DataFrame:
    """The second round of questions."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        own = _Slice(row, longest, bits)
        n, _ = own.answered(right.to_pylist(), bits, least)
        if len(own.keys) == 1:
            own.add_longer(n >= least)
        return _questions(own, row["slice"], bits, 1)

    return sequences.groupBy("slice").cogroup(totals.groupBy("slice")).applyInArrow(run, _ASKED_SQL)


def _totals(asked: DataFrame, bits: int) -> DataFrame:
    """``slice, part, round, counts, named``: counts over all slices, in the order asked, and which of them to report."""
    def run(table: pa.Table) -> pa.Table:
        start = table.column("part")[0].as_py() << (64 - bits)
        keys = [_unpack_keys(blob.as_py(), start) for blob in table.column("keys")]
        ends = np.cumsum([len(k) for k in keys])
        n = np.concatenate([_unpack_counts(blob.as_py(), len(k)) for blob, k in zip(table.column("counts"), keys)])
        keys = np.concatenate(keys)
        order, new = grouped(keys)
        sums = np.add.reduceat(n[order], np.flatnonzero(new))
        n[order] = sums[np.cumsum(new) - 1]
        named = np.zeros(len(keys), bool)
        named[order[new]] = True
        cuts = list(zip([0, *ends[:-1].tolist()], ends.tolist()))
        return pa.table({"slice": table.column("slice"), "part": table.column("part"), "round": table.column("round"),
                         "counts": pa.array([_pack_counts(n[a:b]) for a, b in cuts], pa.binary()),
                         "named": pa.array([_pack_flags(named[a:b]) for a, b in cuts], pa.binary())})

    return asked.groupBy("part").applyInArrow(run, _TOTALS)


def _reported(sequences: DataFrame, totals: DataFrame, longest: int, bits: int, least: int) -> DataFrame:
    """Runs that each slice has to report (see ``context_tables``).

    A row of length 0 per slice has its tokens to learn from as ``n``, and as ``total`` its distinct words of them.
    """
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        own = _Slice(row, longest, bits)
        n, named = own.answered(right.to_pylist(), bits, least)
        tokens, distinct = int(own.learnt[own.place > 0].sum()), int((named[own.single] & (n[own.single] > 0)).sum())
        found = [[np.array([x]) for x in (0, 0, 0, 0, tokens, distinct, 0)]]
        todo, keys = named & (n >= least), np.concatenate(own.keys).view(np.int64)
        for length in range(2, len(own.number) + 1):
            at = np.flatnonzero(own.number[length - 1] >= 0)
            at = at[todo[own.number[length - 1][at]]]
            where = np.full(len(n), -1)
            where[own.number[length - 1][at]] = at  # one of its places
            number = np.flatnonzero(where >= 0)
            at = where[number]
            ctx, shorter = own.number[length - 2][at - 1], own.number[length - 2][at]
            found.append([np.full(len(at), length - 1), keys[number], keys[ctx], keys[shorter],
                          n[number], n[ctx], n[shorter]])
        return pa.table([np.concatenate(c) for c in zip(*found)],
                        ["length", "gram", "ctx", "shorter", "n", "total", "under"])

    return sequences.groupBy("slice").cogroup(totals.groupBy("slice")).applyInArrow(run, _GRAMS)


def _part(keys: str, bits: int) -> Column:
    """The range that keys are in."""
    return F.shiftrightunsigned(keys, 64 - bits) if bits else F.lit(0).cast("bigint")


def context_tables(grams: DataFrame, tokens: int, distinct: int, bits: int, depth: int = 3, least: int = 3,
                   context_share: float = 0.0, ratio: float = 1.2) -> list[DataFrame]:
    """``key, value`` by contexts of 1, 2, ... words: what each occurrence of a run adds to a text's score.

    A run adds as a context the factor for words that it does not keep, and as a context
    with one of its kept words what that word has more than by this factor; values of a key
    add up. ``grams`` are contexts of ``length`` words and the next one (``gram``, ``n`` times), with the key
    and count of the context (``ctx``, ``total``) and of the words but the oldest (``shorter``, ``under``).
    """
    normal, lower, found = tokens + 0.5 * (distinct + 1), None, []
    floor, price = max(least, context_share * tokens), 0.5 * math.log10(max(tokens, 2))

    def run(table: pa.Table) -> pa.Table:
        gram, ctx, n, total, under = (table.column(c).to_numpy() for c in ("gram", "ctx", "n", "total", "lower"))
        order, new = grouped(ctx.view(np.uint64))
        gram, ctx, n, total, under = (x[order] for x in (gram, ctx, n, total, under))
        own = np.log10((n - DISCOUNT) / total)
        keep = np.abs(own - under) >= math.log10(ratio)
        first, of = np.flatnonzero(new), np.cumsum(new) - 1
        words, seen, mass, lower_mass, gain = (np.add.reduceat(np.where(keep, x, 0.0), first) for x in (
            1.0, n, 10.0 ** own, 10.0 ** under, n * (own - under)))
        ctx, total = ctx[first], total[first]
        able = (words > 0) & (mass < 1) & (total >= floor)
        rest = np.log10(np.where(able, 1 - mass, 1.0) / np.maximum(1 - lower_mass, 1e-12))
        retained = able & (gain + (total - seen) * rest > price * words)
        rest = np.where(retained, rest, 0.0)
        keep &= retained[of]
        contexts = pa.table({"key": ctx[retained], "p": pa.nulls(int(retained.sum()), pa.float64()),
                             "value": rest[retained]})
        words = pa.table({"key": gram, "p": np.where(keep, own, under + rest[of]),
                          "value": pa.array(own - under - rest[of], mask=~keep)})
        return pa.concat_tables([contexts, words])

    for length in range(1, depth + 1):
        rows = grams.where(F.col("length") == length)
        if lower is None:
            rows = rows.withColumn("lower", F.log10((F.col("under") + 0.5) / normal))
        else:
            rows = rows.join(lower.select(F.col("key").alias("shorter"), F.col("p").alias("lower")), "shorter")
        # contexts stay whole: all their next words are in the range of the context
        level = rows.select(_part("ctx", bits).alias("part"), "gram", "ctx", "n", "total", "lower") \
            .groupBy("part").applyInArrow(run, "key bigint, p double, value double")
        level = stage(level if length < depth else level.where("value is not null"), "level")
        lower = level.where("p is not null")
        found.append(level.where("value is not null").select("key", "value"))
    return found


def _packed_values(values: DataFrame, bits: int) -> DataFrame:
    """``part, keys, values``: the table ``key, value`` as a row per range of keys; values of a key add up."""
    def run(table: pa.Table) -> pa.Table:
        keys, part = table.column("key").to_numpy().view(np.uint64), table.column("part")[0].as_py()
        order, new, keys = numbered(keys)
        sums = np.add.reduceat(table.column("value").to_numpy()[order], np.flatnonzero(new))
        return pa.table({"part": pa.array([part], pa.int64()),
                         "keys": pa.array([_pack_keys(keys, part << (64 - bits))], pa.binary()),
                         "values": pa.array([sums.tobytes()], pa.binary())})

    return values.withColumn("part", _part("key", bits)).groupBy("part").applyInArrow(
        run, "part bigint, keys binary, values binary")


def _answers(asked: DataFrame, values: DataFrame, bits: int) -> DataFrame:
    """``slice, part, round, found, given``: which of the keys asked for have a value, and those values."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known, value = np.zeros(0, np.uint64), np.zeros(0)
        for row in right.to_pylist():
            known, value = _unpack_keys(row["keys"], row["part"] << (64 - bits)), np.frombuffer(row["values"])
        flags, given = [], []
        for part, blob in zip(left.column("part").to_pylist(), left.column("keys")):
            keys = _unpack_keys(blob.as_py(), part << (64 - bits))
            at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
            hit = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            flags.append(_pack_flags(hit))
            given.append(value[at[hit]].tobytes())
        return pa.table({"slice": left.column("slice"), "part": left.column("part"), "round": left.column("round"),
                         "found": pa.array(flags, pa.binary()), "given": pa.array(given, pa.binary())})

    return asked.groupBy("part").cogroup(values.groupBy("part")).applyInArrow(
        run, "slice bigint, part bigint, round int, found binary, given binary")


def _asked_values(sequences: DataFrame, totals: DataFrame, longest: int, bits: int, least: int) -> DataFrame:
    """``slice, part, round, keys``: runs of each slice that can be in the tree."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        own = _Slice(row, longest, bits)
        n, _ = own.answered(right.to_pylist(), bits, least)
        found, first = [], 0
        for round_, keys in enumerate(own.keys):
            keys, first = keys[n[first:first + len(keys)] >= least], first + len(keys)
            found += [{"slice": row["slice"], "part": part, "round": round_, "keys": _pack_keys(keys[a:b], start)}
                      for part, start, a, b in _cut(keys, bits)]
        return pa.Table.from_pylist(found, pa.schema(list(_ASKED)[:4]))

    return sequences.groupBy("slice").cogroup(totals.groupBy("slice")).applyInArrow(
        run, "slice bigint, part bigint, round int, keys binary")


def _scored(sequences: DataFrame, told: DataFrame, longest: int, bits: int, least: int, tokens: int,
            distinct: int) -> DataFrame:
    normal = tokens + 0.5 * (distinct + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own, rows = _Slice(left.to_pylist()[0], longest, bits), right.to_pylist()
        n, _ = own.answered(rows, bits, least)
        value, first = np.zeros(len(n) + 1), 0  # the last for no run, -1
        answers = {(r["round"], r["part"]): r for r in rows if r["found"] is not None}
        for round_, keys in enumerate(own.keys):
            places = first + np.flatnonzero(n[first:first + len(keys)] >= least)
            for part, _, a, b in _cut(keys[places - first], bits):
                answer = answers[round_, part]
                hit = _unpack_flags(answer["found"], b - a)
                value[places[a:b][hit]] = np.frombuffer(answer["given"])
            first += len(keys)
        texts, target = len(own.doc_ids), own.place > 0
        text, single = own.text[target], own.number[0][target]
        logs = np.zeros(len(n))
        logs[own.single] = np.log10((n[own.single] + 0.5) / normal)
        base = np.bincount(text, logs[single], texts)
        adds = np.where(own.last, 0.0, value[own.number[0]])  # a single end is a context before a text only
        for number in own.number[1:]:
            adds += value[number]
        added = np.bincount(own.text, adds, texts)
        return pa.table({
            "doc_id": pa.array(own.doc_ids, pa.int64()), "n_tokens": np.bincount(text, minlength=texts),
            "n_known": np.bincount(text[n[single] > 0], minlength=texts), "train_tokens": np.full(texts, tokens),
            "base_score": base, "score": base + added})

    return sequences.groupBy("slice").cogroup(told.groupBy("slice")).applyInArrow(
        run, "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def _in_portions(table: DataFrame, name: str) -> DataFrame:
    """A written table of slices, with ``portion``."""
    portion = F.pmod(F.xxhash64("slice"), F.lit(PORTIONS)).cast("int")
    return stage(table.withColumn("portion", portion), name, ["portion"])


def score(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = 3,
          least: int = 3, **settings: float) -> DataFrame:
    """Scores of all texts by a tree of those for which ``learn_from`` (of ``doc_id``) holds.

    Columns ``doc_id, n_tokens, n_known, train_tokens, base_score, score``; both scores
    are log10 probabilities, the first from single words alone. ``settings`` are those of
    ``context_tables``.
    """
    docs = one_per_id(documents(docs, id_col, text_col))
    longest, learnt = depth + 1, F.coalesce(learn_from, F.lit(False)).alias("learnt")
    sequences = _in_portions(_sequences(docs.select("doc_id", "text", learnt)), "sequences")
    symbols = sequences.agg(F.sum("symbols")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, symbols * 2 / RANGE_KEYS))))
    totals = _in_portions(_totals(_asked(sequences, longest, bits), bits), "totals")
    if longest > 2:
        totals = totals.unionByName(_in_portions(
            _totals(_asked_longer(sequences, totals, longest, bits, least), bits), "totals"))
    reported = stage(_reported(sequences, totals, longest, bits, least), "reported")
    sums = reported.where("length = 0").agg(F.sum("n"), F.sum("total")).first()
    tokens, distinct = sums[0] or 0, sums[1] or 0
    tables = context_tables(reported, tokens, distinct, bits, depth, least, **settings)
    values = tables[0]
    for table in tables[1:]:
        values = values.unionByName(table)
    values = stage(_packed_values(values, bits), "values")
    none, scored = F.lit(None).cast("binary"), None
    for portion in range(PORTIONS):
        mine = F.col("portion") == portion
        own, counted = sequences.where(mine), totals.where(mine).drop("portion")
        answers = _answers(_asked_values(own, counted, longest, bits, least), values, bits)
        told = counted.withColumns({"found": none, "given": none}) \
            .unionByName(answers.withColumns({"counts": none, "named": none}))
        found = stage(_scored(own, told, longest, bits, least, tokens, distinct), "scored")
        scored = found if scored is None else scored.unionByName(found)
    return scored

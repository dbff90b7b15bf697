"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.session import materialize

#: Bytes of text that a task holds as Python objects at a time.
SLICE_BYTES = 2 << 20


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              carry: tuple[str, ...] = ()) -> DataFrame:
    """Only id (BIGINT), text and the named other columns, whatever else the table holds."""
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"),
                       *(F.col(f"`{name}`") for name in carry))


def one_per_id(docs: DataFrame) -> DataFrame:
    """One row per id: rows without id go, of rows that repeat an id the least text stays.

    Ids are looked at first, which reads one narrow column; texts move only if an
    id does repeat. The result is the same either way.
    """
    docs = docs.where("doc_id is not null")
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return docs
    row = F.struct(*(c for c in docs.columns if c != "doc_id"))
    return docs.groupBy("doc_id").agg(F.min(row).alias("row")).select("doc_id", "row.*")


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of an id written as decimal text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece has about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; a null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def spans_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of consecutive runs of the given lengths."""
    ends = np.cumsum(lengths)
    return ends - lengths, ends


class Memo(dict):
    """A word table of bounded size in two generations: what is in use outlives a clearing."""

    def __init__(self, limit: int = 200_000) -> None:
        super().__init__()
        self.limit, self.old = limit, {}

    def missing(self, words: set) -> list:
        """Those of ``words`` that have to be computed; the others are in this table afterwards."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        absent = words.difference(self)
        if self.old:
            known = absent.intersection(self.old)
            for word in known:
                self[word] = self.old[word]
            absent -= known
        return list(absent)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None,
                 ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Newton steps for a ridge-penalised logistic model; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(x.shape[1], ridge * weight.sum() / max(1, len(x)) * len(x) / 100)
    penalty[-1] = 1e-9
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_powers: dict[int, np.ndarray] = {}
#: Inverse powers are looked up in two short tables.
_LOW = 1 << 12
#: Bytes whose words are hashed at a time.
_BLOCK = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of 64-bit unsigned integers, and where in it a new one begins."""
    return numbered(keys)[:2]


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stable order of 64-bit unsigned integers, where in it a new one begins, and the distinct ones, sorted.

    Keys are sorted with their place in the low bits, which is faster than sorting places by keys;
    where that leaves keys that share their high bits out of order, places are sorted.
    """
    low = np.uint64((1 << max(1, (len(keys) - 1).bit_length())) - 1)
    order = keys & ~low
    order |= np.arange(len(keys), dtype=np.uint64)
    order.sort()
    order &= low
    order = order.view(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[:len(keys)]
    return order, new, ordered[new]


def powers(base: int, size: int) -> np.ndarray:
    """base**i modulo 2**64 for i below ``size``."""
    have = _powers.get(base)
    if have is None or len(have) < size:
        have = np.ones(max(size, _LOW), np.uint64)
        done = 1
        while done < len(have):  # doubles what is there
            more = min(done, len(have) - done)
            have[done:done + more] = have[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
        _powers[base] = have
    return have[:size]


def inverse_powers(base: int, at: np.ndarray) -> np.ndarray:
    """base**-i modulo 2**64 for each i in ``at``."""
    inverse = pow(base, -1, 1 << 64)
    low = powers(inverse, _LOW)[at & (_LOW - 1)]
    high = powers(pow(inverse, _LOW, 1 << 64), int(at.max(initial=0)) // _LOW + 1)
    return low * high[at // _LOW]


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts of an Arrow column, without Python objects.

    ``starts`` and ``ends`` point into ``data``; the words of text ``i`` are those
    from ``first[i]`` up to ``first[i + 1]``.
    """

    def __init__(self, column: pa.Array, lower: bool = False) -> None:
        column = pc.fill_null(column.cast(pa.binary()), b"")
        offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0])) \
            if raw is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        offsets = (offsets - offsets[0]).astype(np.int64)
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        solid = ~_SPACE[data]
        begins, stops = edge[:-1].copy(), edge[1:].copy()
        if len(data):
            begins[1:] |= ~solid[:-1]
            stops[:-1] |= ~solid[1:]
        self.starts = np.flatnonzero(solid & begins)
        self.ends = np.flatnonzero(solid & stops) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, which: int = 0) -> np.ndarray:
        """64 bits per word; the two kinds are independent of each other."""
        base, found = _BASES[which], np.empty(len(self), np.uint64)
        # a hash doesn't depend on where the word stands, so blocks that fit a cache are done one by one
        cuts = np.searchsorted(self.starts, np.arange(0, len(self.data), _BLOCK)).tolist() + [len(self)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            first, size = self.starts[a], int(self.ends[b - 1] - self.starts[a])
            starts, ends = self.starts[a:b] - first, self.ends[a:b] - first
            sums = np.zeros(size + 1, np.uint64)
            values = self.data[first:first + size].astype(np.uint64)
            values += np.uint64(1)
            values *= powers(base, size)
            np.cumsum(values, out=sums[1:])
            h = (sums[ends] - sums[starts]) * inverse_powers(base, starts)
            found[a:b] = mix(h + (ends - starts).astype(np.uint64) * np.uint64(base | 2))
        return found

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def _edges(self) -> list[np.ndarray]:
        """Length, first eight and last eight bytes of every word (zeros before a shorter one)."""
        padded = np.concatenate([np.zeros(8, np.uint8), self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.data) + 9, "<u8", padded, 0, (1,))  # from each byte on
        length = self.ends - self.starts
        keep = (np.uint64(1) << np.minimum(length * 8, 63).astype(np.uint64)) - np.uint64(1)
        keep[length >= 8] = np.uint64(0xFFFFFFFFFFFFFFFF)
        return [length.astype(np.uint64), eight[self.starts + 8] & keep, np.where(length >= 8, eight[self.ends], 0)]

    def distinct(self, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """An occurrence of each distinct word, and for every word the number of its distinct one.

        Words are told apart by 64 bits of hash (``hashes()``, if at hand), their length, and
        sixteen bytes of themselves.
        """
        h = self.hashes() if hashes is None else hashes
        order, new = grouped(h)
        code = np.empty(len(h), np.int64)
        code[order] = np.cumsum(new) - 1
        at = order[new]
        edges = self._edges()
        if any((edge[at][code] != edge).any() for edge in edges):  # two words share a hash
            _, at, code = np.unique(np.column_stack([h, *edges]), axis=0, return_index=True, return_inverse=True)
            code = code.ravel()
        return at, code

    def lines(self, which: np.ndarray) -> str:
        """Some words, one a line."""
        if not len(which):
            return ""
        sizes = (self.ends - self.starts)[which] + 1
        data = gather(np.append(self.data, np.uint8(10)), self.starts[which], sizes)
        data[np.cumsum(sizes) - 1] = 10
        return data[:-1].tobytes().decode()


def gather(table: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs ``table[starts[i] : starts[i] + counts[i]]`` one after another."""
    begin, end = spans_of(counts)
    total = int(end[-1]) if len(end) else 0
    return table[np.repeat(starts - begin, counts) + np.arange(total)]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, use: Column, per_class: int,
                    seed: int) -> tuple[DataFrame, dict[int, int]]:
    """Texts of at most ``per_class`` labelled ids of each class, and how many ids each class has.

    ``docs`` has ``doc_id`` and ``text``; ``labels`` has ``doc_id`` and ``label`` (0 or 1,
    other rows are left out; of several labels of an id the largest counts). ``use``
    says which ids may be learnt from. Which ids are drawn depends on their hash alone.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")) \
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)) \
        .groupBy("doc_id").agg(F.max("label").alias("label")).where(use)
    sizes = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    order = F.xxhash64("doc_id", F.lit(seed))
    zero, one = (known.where(F.col("label") == value).orderBy(order, "doc_id").limit(per_class) for value in (0, 1))
    # at most 2 * per_class pairs of integers, as a table whose size the planner sees
    drawn = stage(zero.unionByName(one), "drawn")
    return docs.join(drawn, "doc_id").select("doc_id", "label", "text"), sizes


def class_weights(y: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Weights that give a sample the class shares it was drawn from."""
    weight = np.ones(len(y))
    for value in (0, 1):
        mine = y == value
        if mine.any():
            weight[mine] = sizes.get(value, 0) / mine.sum()
    return weight / weight.mean() if len(y) else weight


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a shared table and read it again; the shuffles that made it are removed at once.

    A reader that asks for some values of the columns ``by`` reads the files of those alone.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN_UP, None)
    conf.set(_CLEAN_UP, "true")
    try:
        return materialize(df, name, by)
    finally:
        if before is None:
            conf.unset(_CLEAN_UP)
        else:
            conf.set(_CLEAN_UP, before)

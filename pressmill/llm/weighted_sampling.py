"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words; the weight of a word is how often it occurs
times its length, so a text's weight is spread over its characters. For every
sample k a term has r and c from a gamma distribution and b from [0, 1). With
t = floor(ln w / r + b), the term for which ln c - r (t - b + 1) is least is drawn.
Two texts draw the same term with the same t with a probability equal to their
generalised Jaccard similarity: the sum of the smaller over that of the larger
weights. A fingerprint keeps 32 bits of what each sample drew, so the share of
equal places in two fingerprints estimates the similarity.

The gamma values come from a pool made by a seeded generator; which entry a term
uses in sample k depends on two hashes of the term and on k. Two terms share an
entry with a probability of 1 to ``POOL``.

Fingerprints are made row by row. To compare neighbours, rows are dealt into
ranges of the id, and one row per range goes with the range before it too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import Words, as_texts, documents, mix, slices

SAMPLES = 64
POOL = 1 << 16
_SEED = 20240229
#: Text terms times samples that are worked on together.
_CELLS = 1 << 18
_pool: list[np.ndarray] = []


def _gammas() -> list[np.ndarray]:
    """1 / r, b, ln c and r; one pool for each Python worker."""
    if not _pool:
        draw = np.random.default_rng(_SEED)
        r, c = draw.gamma(2.0, 1.0, POOL), draw.gamma(2.0, 1.0, POOL)
        _pool.extend(x.astype(np.float32) for x in (1 / r, draw.random(POOL), np.log(c), r))
    return _pool


def _weighted_terms(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and ln weight of the distinct terms of each text, in order of the texts."""
    hashes = words.hashes()
    text = np.repeat(np.arange(len(words.first) - 1), words.per_text())
    order = np.lexsort((hashes, text))
    h, text = hashes[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(h)))
    length = (words.ends - words.starts)[order][at]
    return text[at], h[at], np.log(times * length).astype(np.float32)


def signatures(column: pa.Array, samples: int = SAMPLES) -> np.ndarray:
    """A row of ``samples`` 32-bit values per text; all zero for a text without words."""
    r_inverse, b, c, r = _gammas()
    text, h, weight = _weighted_terms(Words(column))
    least = np.full((len(column), samples), np.inf, np.float32)
    # a term of the same weight draws the same in every text
    _, at, code = np.unique(mix(h + mix(weight.view(np.uint32).astype(np.uint64))),
                            return_index=True, return_inverse=True)
    step = ((h[at] >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]
    h, weight = h[at].astype(np.uint32)[:, None], weight[at][:, None]
    k = np.arange(samples, dtype=np.uint32)
    drawn = np.empty((len(at), samples), np.float32)
    rows = max(1, _CELLS // samples)
    for low in range(0, len(at), rows):
        part = slice(low, low + rows)
        entry = (h[part] + k * step[part]) & np.uint32(POOL - 1)
        shift = b[entry]
        t = weight[part] * r_inverse[entry]
        t += shift
        np.floor(t, out=t)
        t -= shift
        t += 1
        t *= r[entry]
        np.subtract(c[entry], t, out=drawn[part])
    for low in range(0, len(code), rows):
        part = slice(low, low + rows)
        starts = np.flatnonzero(np.append(True, np.diff(text[part]) > 0))
        mine = text[part][starts]
        least[mine] = np.minimum(least[mine], np.minimum.reduceat(drawn[code[part]], starts, axis=0))
    # the least value tells the term and t, so it stands for both
    bits = mix(least.view(np.uint32).astype(np.uint64) + np.uint64(1)) >> np.uint64(32)
    return np.where(np.isinf(least), np.uint32(0), bits.astype(np.uint32) | np.uint32(1))


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of equal places; texts without words are alike among themselves and to no other."""
    return (left == right).mean(axis=1)


def _hex(signature: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in np.ascontiguousarray(signature).astype(">u4")]


def fingerprints(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row: 8 hexadecimal digits per sample.

    Equal texts have equal fingerprints; a null text is an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(_hex(signatures(part.column("text"), samples)))],
                ["doc_id", "fingerprint"])

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fingerprint string")


def _with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """Partitions in which each row is followed by the next in descending order of id.

    The order is by descending id (rows without id last), then text; after the last
    comes the first. Columns ``part, lent, doc_id, text``: a lent row only follows
    the last of its part. Only the cut points and one id per range go to the driver.
    """
    cuts: list[int] = []
    if ranges > 1:
        found = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()
        cuts = sorted(set(found[0] or []))
    lowest = -(1 << 63)

    def parts_of(ids: pa.Array) -> np.ndarray:
        return np.searchsorted(cuts, ids.fill_null(lowest).to_numpy(zero_copy_only=False), side="left")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = parts_of(batch.column("doc_id"))
            yield pa.RecordBatch.from_arrays([pa.array(part), batch.column("doc_id")], ["part", "doc_id"])

    firsts = {row["part"]: row["first"] for row in docs.select("doc_id").mapInArrow(
        ends, "part bigint, doc_id bigint").groupBy("part").agg(F.max("doc_id").alias("first")).collect()}
    order = sorted(firsts, reverse=True)
    borrower = dict(zip(order[1:] + order[:1], order))  # the part that the first of a part is lent to

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, ids = parts_of(batch.column("doc_id")), batch.column("doc_id").to_pylist()
            lent = [i for i, p in enumerate(part.tolist()) if ids[i] == firsts[p]]
            for rows, to, flag in ((batch, part, False),
                                   (batch.take(pa.array(lent, pa.int64())),
                                    [borrower[p] for p in part[lent].tolist()], True)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int64()), pa.array([flag] * rows.num_rows, pa.bool_()), *rows.columns],
                    ["part", "lent", "doc_id", "text"])

    return docs.mapInArrow(deal, "part bigint, lent boolean, doc_id bigint, text string") \
        .repartitionByRange(max(1, len(order)), "part") \
        .sortWithinPartitions("part", "lent", F.desc_nulls_last("doc_id"), "text")


def compare_with_next(docs: DataFrame, samples: int = SAMPLES, ranges: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edited one, and how alike they and the next are.

    The edited text has its last half (rounded down, in code points) replaced by as
    many code points from the start of the next text, or all that it has. Columns
    ``doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    docs = documents(docs, id_col, text_col)
    if ranges is None:
        ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def emit(rows: list[tuple], follower: str) -> pa.RecordBatch:
        texts = [text for _, _, _, text in rows]
        edited = [text[:len(text) - len(text) // 2] + after[:len(text) // 2]
                  for text, after in zip(texts, [*texts[1:], follower])]
        found = signatures(pa.array([*texts, follower, *edited]), samples)
        own, changed = found[:len(texts) + 1], found[len(texts) + 1:]
        keep = [i for i, row in enumerate(rows) if not row[1]]
        mine = own[:-1][keep]
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][2] for i in keep], pa.int64()),
             pa.array([len(texts[i]) for i in keep], pa.int64()),
             pa.array([edited[i] for i in keep], pa.string()), pa.array(_hex(mine), pa.string()),
             pa.array(_hex(changed[keep]), pa.string()), pa.array(likeness(mine, changed[keep])),
             pa.array(likeness(mine, own[1:][keep]))],
            ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # rows whose follower has not come yet; the last of them at least
        for part in slices(batches):
            rows = list(zip(part.column("part").to_pylist(), part.column("lent").to_pylist(),
                            part.column("doc_id").to_pylist(), as_texts(part.column("text"))))
            waiting += rows
            if len(waiting) > 1:
                yield emit(waiting[:-1], waiting[-1][3])
                waiting = waiting[-1:]
        if waiting:  # a lent row
            yield emit(waiting, "")

    return _with_next(docs, ranges).mapInArrow(
        run, "doc_id bigint, n_chars bigint, edited string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")

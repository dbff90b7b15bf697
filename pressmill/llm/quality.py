"""Quality score by compression with dictionaries of good and of bad text.

A zstandard dictionary is built from blocks of text labelled good, another from
blocks labelled bad. A text is cut into blocks and each is compressed with both;
what the good dictionary saves against the bad one, per byte of text, is the
evidence. Other labelled texts than those in the dictionaries calibrate it: a
logistic model turns the difference of the whole text and that of its worst block
into the probability of a good text. As a few words say little, it also knows how
short a text is.

Labels are learnt from a bounded sample (``per_class`` texts, ``max_blocks`` blocks
of ``BLOCK`` bytes a class); scoring reads every whole text and shuffles nothing.
A null or empty text has no difference and gets the score of that. Repeated rows
and null ids are scored each. Without labels of both classes every score is the
smoothed share of good labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import (
    as_bytes, class_weights, documents, fit_logistic, labelled_sample, logistic, slices,
)
from pressmill.session import materialize

BLOCK = 512
#: Shorter ends of a text don't count as its worst block.
_LEAST = 64
_LEVEL = 3
#: Bytes of a text that is half as short as an empty one.
BRIEF = 64


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    coefficients: tuple[float, ...]  # of the columns of _differences, and the intercept


_compressors: dict[bytes, zstandard.ZstdCompressor] = {}


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """One for each dictionary and Python worker."""
    if dictionary not in _compressors:
        data = None
        if dictionary:
            data = zstandard.ZstdCompressionDict(dictionary)
            data.precompute_compress(level=_LEVEL)
        _compressors[dictionary] = zstandard.ZstdCompressor(
            level=_LEVEL, dict_data=data, write_content_size=False, write_checksum=False,
            write_dict_id=False)
    return _compressors[dictionary]


def _differences(texts: list[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """Per text: bytes saved by the good dictionary, per byte; the same of its worst block;
    shortness (1 for an empty text); the first for short texts."""
    with_good, with_bad = _compressor(good).compress, _compressor(bad).compress
    out = np.zeros((len(texts), 4))
    out[:, 2] = [1 / (1 + len(text) / BRIEF) for text in texts]
    for i, text in enumerate(texts):
        if not text:
            continue
        blocks = [text[j:j + BLOCK] for j in range(0, len(text), BLOCK)]
        saved = [len(with_bad(b)) - len(with_good(b)) for b in blocks]
        if len(blocks) > 1 and len(blocks[-1]) < _LEAST:
            worst = min(saved[:-1]) / BLOCK
        else:
            worst = min(s / len(b) for s, b in zip(saved, blocks))
        out[i, :2] = sum(saved) / len(text), worst
    out[:, 3] = out[:, 0] * out[:, 2]
    return out


def _dictionary(blocks: list[bytes], size: int) -> bytes:
    if not blocks:
        return b""
    try:
        return zstandard.train_dictionary(size, blocks).as_bytes()
    except zstandard.ZstdError:  # too little text to select from: all of it is the dictionary
        return b"".join(blocks)[-size:]


def fit(docs: DataFrame, labels: DataFrame, label: str, use: Column, per_class: int = 3000,
        max_blocks: int = 8000, dictionary_bytes: int = 64 << 10, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    """Dictionaries and calibration from the ids of ``labels`` for which ``use`` holds."""
    drawn, sizes = labelled_sample(documents(docs, id_col, text_col), labels, label, use, per_class, seed=1)
    share = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    constant = Model(b"", b"", (*[0.0] * 4, float(np.log(share / (1 - share)))))
    if len(sizes) < 2:
        return constant
    sample = materialize(drawn.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2))), "sample")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = [(label, text[j:j + BLOCK]) for label, text in
                    zip(part.column("label").to_pylist(), as_bytes(part.column("text")))
                    for j in range(0, len(text), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                ["label", "block"])

    blocks = sample.where("half = 0").select("label", "text").mapInArrow(cut, "label int, block binary")
    good, bad = (_dictionary([row["block"] for row in blocks.where(F.col("label") == value).orderBy(
        F.xxhash64("block"), "block").limit(max_blocks).collect()], dictionary_bytes) for value in (1, 0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = _differences(as_bytes(part.column("text")), good, bad)
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), *map(pa.array, found.T)], ["label", *"abcd"])

    rows = np.array(sample.where("half = 1").select("label", "text").mapInArrow(
        measure, "label int, a double, b double, c double, d double").collect(), float).reshape(-1, 5)
    if len(np.unique(rows[:, 0])) < 2:
        return constant
    scale = rows[:, 1:].std(axis=0) + 1e-9
    beta = fit_logistic(rows[:, 1:] / scale, rows[:, 0], class_weights(rows[:, 0], sizes))
    return Model(good, bad, (*(beta[:-1] / scale).tolist(), float(beta[-1])))


def score_column(text: Column | str, model: Model) -> Column:
    """Probability that a text is good."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        beta = np.array(model.coefficients)
        found = [np.zeros((0, 4))]
        for part in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
            found.append(_differences(as_bytes(part.column("text")), model.good, model.bad))
        return pa.array(logistic(np.concatenate(found) @ beta[:-1] + beta[-1]))

    return score(F.col(text).cast("string") if isinstance(text, str) else text)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row."""
    return documents(docs, id_col, text_col).select("doc_id", score_column("text", model).alias("score"))

"""N-grams of token lists and their counts, for many documents at a time.

Tokens arrive as Arrow lists. The words of some documents are numbered, an n-gram is a pair of
numbers, and counting is a sort of integers; only distinct terms are ever spelt out. Documents
are taken in slices of ``SLICE_TOKENS`` tokens, so that memory does not follow the batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The counting travels with the job, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_TOKENS = 500_000
PAIRS = "array<struct<term:string,tf:bigint>>"
_PAIR = pa.struct([("term", pa.string()), ("tf", pa.int64())])


def _cuts(lists: pa.ListArray) -> Iterator[pa.ListArray]:
    """Runs of documents of about ``SLICE_TOKENS`` tokens, at least one document each."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(lists):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE_TOKENS, "right")))
        yield lists.slice(at, to - at)
        at = to


def _count(lists: pa.ListArray, low: int, high: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms; and of each pair of document and term, by document: document, term, count."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(lists)), lengths)
    encoded = lists.flatten().dictionary_encode()
    words, code = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names, docs, grams, first = [], [], [], 0
    gram, spelt, here = code, words, doc
    for n in range(1, high + 1):
        if n > 1:
            # the n-gram that begins here is the shorter one and the word after it
            same = here[:len(doc) - n + 1] == doc[n - 1:]
            begins = np.flatnonzero(same)
            key, gram_of = np.unique(gram[begins] * len(words) + code[begins + n - 1], return_inverse=True)
            older, last = key // max(1, len(words)), key % max(1, len(words))
            spelt = pc.binary_join_element_wise(spelt.take(pa.array(older)), words.take(pa.array(last)), " ")
            gram = np.zeros(len(doc), np.int64)
            gram[begins] = gram_of
            # documents end at their last whole n-gram
            here = np.full(len(doc), -1)
            here[begins] = doc[begins]
        if n >= low:
            used = here >= 0
            names.append(spelt)
            docs.append(here[used])
            grams.append(gram[used] + first)
            first += len(spelt)
    # terms of different n can be spelt alike
    spelt = pa.concat_arrays([name.cast(pa.string()) for name in names]).dictionary_encode()
    number = spelt.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(1, len(spelt.dictionary))
    key, tf = np.unique(np.concatenate(docs) * size + number[np.concatenate(grams)], return_counts=True)
    return spelt.dictionary, key // size, key % size, tf


def _pairs(lists: pa.ListArray, low: int, high: int) -> pa.Array:
    parts = []
    for some in _cuts(lists):
        terms, doc, term, tf = _count(some, low, high)
        ends = np.cumsum(np.bincount(doc, minlength=len(some)))
        entries = pa.StructArray.from_arrays([terms.take(pa.array(term)), pa.array(tf.astype(np.int64))], fields=list(_PAIR))
        parts.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), entries))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(_PAIR))


def pairs_of(tokens: Column | str, low: int = 1, high: int = 1) -> Column:
    """The distinct terms of a token list with their counts, as an array of ``term, tf``."""
    @F.arrow_udf(PAIRS)
    def count(lists: pa.Array) -> pa.Array:
        return _pairs(lists, low, high)

    return count(F.col(tokens) if isinstance(tokens, str) else tokens)


def document_counts(tokens: DataFrame, fields: dict[str, tuple[str, int, int]]) -> DataFrame:
    """``field, term, df, tf``: the counts of some documents each, to be added up.

    ``fields`` has for each name its column of tokens and the bounds of n.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, (column, low, high) in fields.items():
                for some in _cuts(batch.column(column)):
                    terms, _, term, tf = _count(some, low, high)
                    sums = np.bincount(term, tf, len(terms)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(terms), pa.string()), terms,
                         pa.array(np.bincount(term, minlength=len(terms)).astype(np.int64)), pa.array(sums)],
                        ["field", "term", "df", "tf"])

    columns = dict.fromkeys(column for column, *_ in fields.values())
    return tokens.select(*columns).mapInArrow(run, "field string, term string, df bigint, tf bigint")

"""How filters of a corpus interact: what each removes first, again, or alone, in every order.

Every document gets a mask of the filters it fails. Four filters look at one text; the
fifth, "identical to an earlier text", looks at the whole table and is answered by a
counting Bloom filter: tasks count the cells of their own texts, the sparse sketches
are merged cell block by cell block, and a text with a cell that was counted once is
unique for certain. Only the others are shuffled whole and grouped by their full text,
which leaves the least id of each; a group of copies leaves a map task as one row.

The sketch has twelve cells a text, of which each sets four, and, once merged, one bit a cell;
under one in a hundred unique texts is taken for a possible repeat. It is cut into
blocks, and all cells of a text lie in one block, so that blocks are merged and probed
apart from each other. Below ``BROADCAST_BYTES`` it is broadcast and probed where the
texts are read; a larger one is joined by block with ids and hashes alone, and
the texts of possible repeats are then fetched by id.

Masks are additive: documents are counted per (part, mask) first, and all orders and
steps are sums over at most 2**filters rows per part.

Defined results: a null text is empty, a null part is the empty string. Each row counts
as a document, also one that repeats an id. A row without id is never earlier than
another and never later: it is counted, and fails no duplicate test. Of several
labels of an id the largest counts. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import documents, stage
from pressmill.session import with_settings

#: Cells of a block, a power of two; all cells of a text lie in one block.
BLOCK_CELLS = 1 << 15
CELLS_A_TEXT = 12
PROBES = 4
#: A merged sketch up to this size is broadcast.
BROADCAST_BYTES = 32 << 20
#: Texts whose cells a task counts at a time.
_BATCH = 500_000
_SPACES = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """Maximal runs of other characters than blanks, tabs and line ends."""
    return F.array_remove(F.split(text, _SPACES), "")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that one text decides: short, repetitive, upper case, special characters."""
    found = words(text)
    return {
        "A": F.size(found) < 50,
        "B": 100 * F.size(F.array_distinct(found)) < 65 * F.size(found),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _block(blocks: int) -> Column:
    return F.pmod("h", F.lit(blocks).cast("bigint"))


def _probes() -> list[Column]:
    """Cells of the hash ``h`` within its block: a start and an odd stride from bits the block does not use."""
    mixed = F.xxhash64("h", F.lit(1))
    stride = F.shiftrightunsigned(mixed, 32).bitwiseOR(F.lit(1))
    low = F.lit(BLOCK_CELLS - 1)
    return [((mixed.bitwiseAND(low) + i * stride.bitwiseAND(low)).bitwiseAND(low)).cast("int") for i in range(PROBES)]


def sketch(hashes: DataFrame, blocks: int) -> DataFrame:
    """``block, bits``: the bit of a cell is set if it was counted twice or more.

    ``hashes`` has a BIGINT ``h`` per text. Counters saturate at two, in tasks and when merged.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            cells, counts = np.unique(np.concatenate(held), return_counts=True)
            block = cells // BLOCK_CELLS
            first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            last = np.append(first[1:], len(block))
            inner, total = (cells % BLOCK_CELLS).astype("<u2"), np.minimum(counts, 2).astype(np.uint8)
            return pa.RecordBatch.from_arrays(
                [pa.array(block[first]), *(pa.array([x[a:b].tobytes() for a, b in zip(first, last)], pa.binary())
                                           for x in (inner, total))], ["block", "cells", "counts"])

        for batch in batches:
            block = batch.column("block").to_numpy() * BLOCK_CELLS
            for i in range(PROBES):
                held.append(block + batch.column(f"cell{i}").to_numpy())
            size += batch.num_rows
            if size > _BATCH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BLOCK_CELLS, np.int64)
        for batch in batches:
            for cells, counts in zip(batch.column("cells").to_pylist(), batch.column("counts").to_pylist()):
                total[np.frombuffer(cells, "<u2")] += np.frombuffer(counts, np.uint8)
        bits = np.packbits(total >= 2, bitorder="little").view("<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int64()), pa.array([bits], pa.list_(pa.int64()))], ["block", "bits"])

    placed = hashes.select(_block(blocks).alias("block"), *(p.alias(f"cell{i}") for i, p in enumerate(_probes())))
    sparse = placed.mapInArrow(count, "block bigint, cells binary, counts binary")
    return stage(sparse.groupBy("block").applyInArrow(merge, "block bigint, bits array<bigint>"), "sketch")


def _possible(rows: DataFrame, merged: DataFrame, blocks: int) -> DataFrame:
    """Rows (with a hash ``h``) all of whose cells were counted twice or more."""
    hits = F.lit(True)
    for cell in _probes():
        word = F.get("bits", F.shiftright(cell, 6))
        hits = hits & (F.getbit(word, cell.bitwiseAND(F.lit(63))) == 1)
    return rows.withColumn("block", _block(blocks)).join(merged, "block").where(hits).drop("block", "bits")


def repeats(rows: DataFrame, texts: DataFrame, n_rows: int) -> DataFrame:
    """``doc_id, h`` of the rows whose text stands in a row of smaller id too.

    ``rows`` has ``doc_id, h`` and ``texts`` has ``doc_id, text, h`` of the same rows, ids not null.
    """
    blocks = max(1, -(-n_rows * CELLS_A_TEXT // BLOCK_CELLS))
    merged = sketch(rows, blocks)
    spark = rows.sparkSession
    if blocks * BLOCK_CELLS // 8 <= BROADCAST_BYTES:
        # the planner broadcasts the written sketch, so that texts are tested where they are read
        with with_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_BYTES)}):
            again = stage(_possible(rows, merged, blocks), "again")
            first = stage(_first(_possible(texts, merged, blocks)), "first")
    else:
        again = stage(_possible(rows, merged, blocks), "again")
        first = _first(texts.join(again.distinct(), ["doc_id", "h"], "left_semi"))
    return again.join(first, ["doc_id", "h"], "left_anti")


def _first(texts: DataFrame) -> DataFrame:
    """``doc_id, h`` of the least id of each text; a group of copies leaves a map task as one row."""
    least = texts.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    return least.select("doc_id", F.xxhash64("text").alias("h"))


def mask_counts(docs: DataFrame, labels: DataFrame, filters: Callable[[Column], Mapping[str, Column]] = text_filters,
                part: str = "source", outcomes: Mapping[str, str] | None = None) -> DataFrame:
    """``part, mask, n`` and a sum per outcome: documents by the set of filters they fail.

    Bit i of ``mask`` belongs to the i-th filter, the last bit to the duplicate test.
    ``outcomes`` maps a result column to the 0/1 column of ``labels`` it counts.
    """
    outcomes = outcomes or {"good": "quality", "toxic": "toxic"}
    texts = documents(docs, carry=(part,) if part not in ("doc_id", "text") else ()).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"))
    tests = filters(F.col("text"))
    bits = [F.when(test, F.lit(1 << i)).otherwise(F.lit(0)) for i, test in enumerate(tests.values())]
    flags = stage(texts.select("doc_id", "part", F.xxhash64("text").alias("h"),
                               sum(bits, F.lit(0)).alias("mask")), "flags")
    named = flags.where("doc_id is not null")
    found = repeats(named.select("doc_id", "h"),
                    texts.where("doc_id is not null").select("doc_id", "text", F.xxhash64("text").alias("h")),
                    named.count())
    later = found.distinct().withColumn("later", F.lit(1 << len(bits)))
    marked = stage(named.join(later, ["doc_id", "h"], "left").select(
        "doc_id", "part", (F.col("mask") + F.coalesce("later", F.lit(0))).alias("mask")).unionByName(
        flags.where("doc_id is null").select("doc_id", "part", "mask")), "marked")
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), *(
        F.when(F.col(f"`{c}`") == 1, 1).otherwise(0).cast("bigint").alias(o) for o, c in outcomes.items())) \
        .where("doc_id is not null").groupBy("doc_id").agg(*(F.max(o).alias(o) for o in outcomes))
    zero = F.lit(0).cast("bigint")
    all_of_them = marked.groupBy("part", "mask").agg(F.count("*").alias("n"), *(F.first(zero).alias(o) for o in outcomes))
    labelled = marked.join(known, "doc_id").groupBy("part", "mask").agg(
        F.first(zero).alias("n"), *(F.sum(o).alias(o) for o in outcomes))
    return all_of_them.unionByName(labelled).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *(F.sum(o).alias(o) for o in outcomes))


def interactions(counts: DataFrame, names: Sequence[str], outcomes: Sequence[str] = ("good", "toxic")) -> DataFrame:
    """Effect of every step of every order of the filters, per part, from additive mask counts.

    A step depends on its filter and on the set of filters before it only, so sums are
    taken once for each such pair and then given to the orders it occurs in.
    """
    n = len(names)
    full = range(1 << n)
    pairs = F.array(*(F.struct(F.lit(before).alias("before"), F.lit(1 << i).alias("own"))
                      for before in full for i in range(n) if not before >> i & 1))
    orders = counts.sparkSession.createDataFrame(
        [("".join(names[i] for i in order), step + 1, sum(1 << i for i in order[:step]), 1 << own)
         for order in itertools.permutations(range(n)) for step, own in enumerate(order)],
        "filter_order string, step int, before int, own int")
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("before")) != 0
    here = fails & ~earlier

    def total(test: Column, value: str | Column = "n") -> Column:
        return F.sum(F.when(test, F.col(value) if isinstance(value, str) else value).otherwise(0))

    # of all orders of the filters a document fails, each of them comes first equally often
    share = F.col("n") * math.factorial(n) / F.bit_count(F.col("mask"))
    sums = counts.select("*", F.inline(pairs)).groupBy("part", "before", "own").agg(
        total(~fails & ~earlier).alias("kept"), total(here).alias("removed"), total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        *(total(here, o).alias(f"{o}_lost") for o in outcomes),
        total(fails, F.round(share).cast("bigint")).alias("shapley"))
    return sums.join(orders, ["before", "own"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        *(f"{o}_lost" for o in outcomes), "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A to E of this module over whole texts, in all 120 orders, per source."""
    return interactions(mask_counts(docs, labels), "ABCDE")


def audit_sql() -> str:
    """The same rows as DuckDB SQL."""
    return r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
  max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  (CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END) ||
  (CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END) ||
  (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END) ||
  (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END) ||
  (CASE WHEN w.doc_id > first THEN 'E' ELSE '' END) AS fails
  FROM w LEFT JOIN known ON w.doc_id = known.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders(o) AS (SELECT l FROM letters UNION ALL
  SELECT o || l FROM orders, letters WHERE length(o) < 5 AND NOT contains(o, l)),
steps AS (SELECT o AS filter_order, s AS step, substr(o, s, 1) AS own, substr(o, 1, s - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s) WHERE length(o) = 5),
counts AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
each AS (SELECT part, filter_order, step, own, n, good, toxic, fails,
  contains(fails, own) AS now, length(translate(fails, before, '')) < length(fails) AS earlier FROM counts, steps),
rows AS (SELECT part, filter_order, step, any_value(own) AS own,
  coalesce(sum(n) FILTER (NOT now AND NOT earlier), 0) AS kept, coalesce(sum(n) FILTER (now AND NOT earlier), 0) AS removed,
  coalesce(sum(n) FILTER (now AND earlier), 0) AS redundant, coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
  coalesce(sum(good) FILTER (now AND NOT earlier), 0) AS good_lost,
  coalesce(sum(toxic) FILTER (now AND NOT earlier), 0) AS toxic_lost
  FROM each GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM rows
""".strip()

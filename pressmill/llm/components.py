"""Connected components of a table of links."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import stage

#: Links that a task joins up at a time.
_BATCH = 200_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every node but the least of each component of the given links to that least node."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[:len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[left], root[right]), np.maximum(root[left], root[right])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    inner = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[inner], nodes[root[inner]]


def _contract(links: DataFrame) -> DataFrame:
    """The same components with fewer links: a task joins up about ``_BATCH`` of them at a time.

    ``links`` is a written table, so neighbouring partitions are put together without
    moving anything.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = b = np.zeros(0, np.int64)
        for batch in batches:
            a = np.concatenate([a, batch.column("a").to_numpy()])
            b = np.concatenate([b, batch.column("b").to_numpy()])
            if len(a) > _BATCH:
                more = forest(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in more], ["a", "b"])
                a = b = np.zeros(0, np.int64)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in forest(a, b)], ["a", "b"])

    tasks = max(1, math.ceil(links.count() / _BATCH))
    return links.coalesce(tasks).mapInArrow(run, "a bigint, b bigint")


def _state(links: DataFrame) -> tuple:
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node with a link; a component is named by its least node.

    ``links`` has two BIGINT columns ``a`` and ``b``, none null. Large-star and
    small-star steps in turn, each a join with the least neighbour of every node, until
    all links lead to the least node: in the order of log n rounds. A hot node is a hot key
    of a join, which adaptive execution splits.
    """
    links = stage(_contract(stage(links.where("a <> b"), "links")), "links")
    before = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        # every link now leads to a smaller node
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        small = small.unionByName(lower.select("a", F.col("m").alias("b"))).where("a <> b")
        links = stage(_contract(stage(small.distinct(), "links")), "links")
        now = _state(links)
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now

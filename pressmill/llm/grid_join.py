"""Near-duplicate vectors by an epsilon grid order join.

A cosine of ``threshold`` or more is a distance of at most eps between unit vectors,
and no less in any orthogonal projection. Vectors are projected on their leading
principal axes and sorted by grid cells of side eps, one axis after another; the
sorted sequence of a label is cut into blocks. Over the blocks lies a tree of
intervals with bounding boxes. Pairs of intervals are joined level by level, from
the top down: a pair whose boxes are farther apart than eps is dropped with all
below it, the others are replaced by the pairs of their parts. What is left at the
bottom are pairs of blocks, compared vector by vector in double precision.

Equal vectors of a label are one vector with a count, so a group of copies adds no
pairs. A task returns, for its pair of blocks, the number of links of each vector
and a spanning forest of the links.

Vectors that are null, zero, or hold null or non-finite components link with nothing,
and neither do those without label. Vectors of different length do not link. Of rows
that repeat an id the least (label, vector) counts, rows without id go; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import stage
from pressmill.llm.components import components, forest

BLOCK = 512
#: Axes of the grid order, and of the bounding boxes.
GRID_AXES, BOX_AXES = 4, 8
FANOUT = 8


def _vectors(binary: pa.Array) -> np.ndarray:
    """Rows of float64 from packed vectors of one length."""
    return np.frombuffer(b"".join(binary.to_pylist()), "<f8").reshape(len(binary), -1)


def _principal_axes(vectors: DataFrame, size: int, axes: int) -> np.ndarray:
    """Leading axes of the unit vectors of the given length, from sums over all of them."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size + size)
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                x = _vectors(batch.column("packed").slice(start, 2048))
                x = x / np.linalg.norm(x, axis=1)[:, None]
                total += np.concatenate([(x.T @ x).ravel(), x.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "v"])

    mine = vectors.where(F.col("size") == size).select("packed")
    rows = mine.mapInArrow(moments, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    total = np.zeros(size * size + size)
    total[rows.column("i").to_numpy()] = rows.column("v").to_numpy()
    count = max(1, mine.count())
    mean = total[size * size:] / count
    _, basis = np.linalg.eigh(total[:size * size].reshape(size, size) / count - np.outer(mean, mean))
    return basis[:, ::-1][:, :axes]


def _near(a: str, b: str, eps: float) -> Column:
    """Whether two boxes are at most eps apart."""
    gaps = [F.greatest(F.lit(0.0), F.col(f"{a}.low{i}") - F.col(f"{b}.high{i}"),
                       F.col(f"{b}.low{i}") - F.col(f"{a}.high{i}")) for i in range(BOX_AXES)]
    return sum((g * g for g in gaps), F.lit(0.0)) <= eps * eps


def _in_order(a: str, b: str) -> Column:
    return (F.col(f"{a}.part") < F.col(f"{b}.part")) | \
        (F.col(f"{a}.part") == F.col(f"{b}.part")) & (F.col(f"{a}.node") <= F.col(f"{b}.node"))


def _block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs of blocks (``part1, node1, part2, node2``) whose boxes are near, by descent of the tree."""
    boxes = [f"{side}{i}" for side in ("low", "high") for i in range(BOX_AXES)]
    group = ["label", "size"]
    meta = stage(blocks.select(*group, "part", F.col("seq").alias("node"), *boxes), "boxes")
    most = meta.agg(F.max("node")).first()[0] or 0
    levels = [meta]
    while most:
        most //= FANOUT
        levels.append(levels[-1].groupBy(*group, "part", F.expr(f"node div {FANOUT}").alias("node")).agg(
            *(F.min(b).alias(b) for b in boxes if b.startswith("low")),
            *(F.max(b).alias(b) for b in boxes if b.startswith("high"))))
    pairs = None
    for nodes in reversed(levels):
        a, b = nodes.alias("a"), nodes.alias("b")
        if pairs is None:
            joined = a.join(b, [F.col(f"a.{g}") == F.col(f"b.{g}") for g in group])
        else:
            p = pairs.alias("p")
            joined = p.join(a, [*(F.col(f"p.{g}") == F.col(f"a.{g}") for g in group),
                                F.col("p.part1") == F.col("a.part"),
                                F.col("p.node1") == F.expr(f"a.node div {FANOUT}")]) \
                .join(b, [*(F.col(f"p.{g}") == F.col(f"b.{g}") for g in group),
                          F.col("p.part2") == F.col("b.part"),
                          F.col("p.node2") == F.expr(f"b.node div {FANOUT}")])
        pairs = stage(joined.where(_in_order("a", "b") & _near("a", "b", eps)).select(
            *(F.col(f"a.{g}") for g in group), F.col("a.part").alias("part1"), F.col("a.node").alias("node1"),
            F.col("b.part").alias("part2"), F.col("b.node").alias("node2")), "pairs")
    return pairs


def _links(vectors: DataFrame, threshold: float) -> DataFrame:
    """``a, b, n``: with b null, n links of vector a; else a link of a spanning forest."""
    eps = math.sqrt(max(0.0, 2 - 2 * threshold)) * (1 + 1e-9) + 1e-9
    common = vectors.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], "a bigint, b bigint, n bigint")
    size = common["size"]
    basis = _principal_axes(vectors, size, BOX_AXES)

    def project(packed: pa.Array, length: int) -> np.ndarray:
        out = np.zeros((len(packed), BOX_AXES))
        if length == size:
            x = _vectors(packed)
            found = x / np.linalg.norm(x, axis=1)[:, None] @ basis
            out[:, :found.shape[1]] = found
        return out

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length in np.unique(batch.column("size").to_numpy()).tolist():
                part = batch.filter(pa.array(batch.column("size").to_numpy() == length))
                cell = np.floor(project(part.column("packed"), length)[:, :GRID_AXES] / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(c) for c in cell.T)],
                    [*part.schema.names, *(f"cell{i}" for i in range(GRID_AXES))])

    order = ["label", "size", *(f"cell{i}" for i in range(GRID_AXES)), "vec_id"]
    fields = "vec_id bigint, label int, size int, copies bigint, packed binary"
    placed = vectors.mapInArrow(cells, fields + "".join(f", cell{i} int" for i in range(GRID_AXES)))
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, None

        def block(rows: pa.Table, seq: int) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            length = rows.column("size")[0].as_py()
            packed = rows.column("packed").chunk(0)
            at = project(packed, length)
            values = [[rows.column("label")[0].as_py()], [length], [part], [seq],
                      [rows.column("vec_id").to_pylist()], [rows.column("copies").to_pylist()],
                      [b"".join(packed.to_pylist())],
                      *([x] for x in (*at.min(axis=0).tolist(), *at.max(axis=0).tolist()))]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, types)], names)

        names = ["label", "size", "part", "seq", "ids", "copies", "packed",
                 *(f"low{i}" for i in range(BOX_AXES)), *(f"high{i}" for i in range(BOX_AXES))]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                 pa.binary(), *[pa.float64()] * (2 * BOX_AXES)]
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            key = np.column_stack([rows.column("label").to_numpy(), rows.column("size").to_numpy()])
            edges = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            starts = [0]
            for stop in [*edges.tolist(), len(key)]:
                while starts[-1] + BLOCK < stop:
                    starts.append(starts[-1] + BLOCK)
                if stop < len(key):
                    starts.append(stop)
            for a, b in zip(starts, starts[1:]):
                yield block(rows.slice(a, b - a), seq)
                seq += 1
            held = rows.slice(starts[-1])
        if held is not None and held.num_rows:
            yield block(held, seq)

    box = "".join(f", {side}{i} double" for side in ("low", "high") for i in range(BOX_AXES))
    blocks = stage(ordered.mapInArrow(
        cut, "label int, size int, part int, seq bigint, ids array<bigint>, copies array<bigint>, packed binary" + box),
        "blocks")
    body = blocks.select("part", "seq", "size", "ids", "copies", "packed")
    pairs = _block_pairs(blocks, eps).drop("size")
    rows = pairs.alias("p").join(body.alias("x"), (F.col("p.part1") == F.col("x.part")) & (F.col("p.node1") == F.col("x.seq"))) \
        .join(body.alias("y"), (F.col("p.part2") == F.col("y.part")) & (F.col("p.node2") == F.col("y.seq"))) \
        .select(((F.col("p.part1") == F.col("p.part2")) & (F.col("p.node1") == F.col("p.node2"))).alias("same"),
                F.col("x.size").alias("size"),
                *(F.col(f"{s}.{c}").alias(f"{c}_{s}") for s in "xy" for c in ("ids", "copies", "packed")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                x, y = (np.frombuffer(row[f"packed_{s}"].as_py(), "<f8").reshape(-1, row["size"].as_py()) for s in "xy")
                ids_x, ids_y, copies_x, copies_y = (row[n].values.to_numpy() for n in (
                    "ids_x", "ids_y", "copies_x", "copies_y"))
                cosine = (x @ y.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(y, axis=1)[None, :]
                link = cosine >= threshold
                if row["same"].as_py():
                    np.fill_diagonal(link, False)
                    count, who = link @ copies_y, ids_x
                else:
                    count, who = np.append(link @ copies_y, copies_x @ link), np.append(ids_x, ids_y)
                left, right = np.nonzero(link)
                a, b = forest(ids_x[left], ids_y[right]) if len(left) else (ids_x[:0], ids_x[:0])
                use = count > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(who[use], a)), pa.array(np.append(who[use], b), mask=np.arange(
                        int(use.sum()) + len(a)) < int(use.sum())),
                     pa.array(np.append(count[use], np.zeros(len(a), np.int64)))], ["a", "b", "n"])

    return rows.mapInArrow(compare, "a bigint, b bigint, n bigint")


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector, links being within a label."""
    rows = embeddings.select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{label_col}`").cast("int").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v")).where("vec_id is not null")
    if not rows.groupBy("vec_id").count().where("count > 1").isEmpty():
        rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    sound = F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            size = v.value_lengths().to_numpy()
            data = (v.flatten().to_numpy() + 0.0).astype("<f8")  # no negative zeros
            ends = np.cumsum(size)
            packed = [data[a:b].tobytes() for a, b in zip((ends - size).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(size.astype(np.int32)),
                 pa.array(packed, pa.binary())], ["vec_id", "label", "size", "packed"])

    vectors = stage(rows.where(sound).mapInArrow(
        pack, "vec_id bigint, label int, size int, packed binary"), "vectors")
    key = ["label", "size", "packed"]
    distinct = stage(vectors.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "distinct")
    members = stage(vectors.join(distinct, key).select("vec_id", "rep", "copies"), "members")
    links = stage(_links(distinct.select(F.col("rep").alias("vec_id"), "label", "size", "copies", "packed"), threshold), "links")
    counts = links.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    named = components(links.where("b is not null").select("a", "b"))
    found = members.join(counts, F.col("rep") == F.col("a"), "left").join(
        named, F.col("rep") == F.col("node"), "left").select(
        "vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    return rows.select("vec_id").join(found, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"))

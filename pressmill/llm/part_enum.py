"""Jaccard self-join of word n-gram sets by PartEnum signatures.

Sets whose similarity reaches the threshold lie in the same or in neighbouring
bands of sizes, and differ in at most k elements, where k follows from the sizes.
For every band the domain of elements is divided into n = k // 2 + 1 + x parts, and
each of these into three: at least x + 1 parts of two such sets differ in one element
at most, so two of their three sub-parts are equal. The signatures of a set are the
three pairs of sub-parts of every part. A set stands for its own band and for the
next one.

A pair of sub-parts that is empty in both sets is equal too, but says nothing. x is
chosen such that nearly all sets have at most x parts with two empty sub-parts; if one
set of two is like that, they share a signature with elements. Sets with more of these
have the empty ones as signatures as well, so no pair is lost.

Equal sets are one set from the start. Those that share a signature form clusters;
a cluster is divided into blocks of bounded size in the order of set sizes. Each pair
of blocks whose sizes are compatible is one task over count sketches: the elements of
a set are counted in cells, and the sum of the differences of two sets' cells is
never more than the number of elements in which they differ. Sets with a partner
that this leaves possible go on, in groups, and only their texts are moved and
compared as whole sets. A task returns a spanning forest of the links it finds,
never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm.common import Words, documents, inverse_powers, mix, one_per_id, powers, slices, stage
from pressmill.llm.components import components, forest

#: Elements of the sets of a block.
BLOCK = 480_000
_BASE = 0xC2B2AE3D27D4EB4F
_ONE = np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Logarithm of the least number of cells of a sketch.
_CELLS = 4


class _Sets:
    """Distinct n-grams of some texts as sorted 64-bit hashes, one text after another."""

    def __init__(self, column: pa.Array, size: int) -> None:
        words = Words(column, lower=True)
        per_text = words.per_text()
        total = len(words)
        sums = np.zeros(total + 1, np.uint64)
        np.cumsum(words.hashes() * powers(_BASE, total), out=sums[1:])
        text = np.repeat(np.arange(len(column)), per_text)
        end = words.first[1:][text] if total else np.zeros(0, np.int64)
        at = np.arange(total)
        short = per_text < size  # the whole text is one
        start = np.flatnonzero((at + size <= end) | short[text] & (at == words.first[:-1][text]))
        stop = np.minimum(start + size, end[start])
        h = mix((sums[stop] - sums[start]) * inverse_powers(_BASE, start) + (stop - start).astype(np.uint64))
        text = text[start]
        order = np.lexsort((h, text))
        h, text = h[order], text[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        self.hash, self.text = h[new], text[new]
        self.counts = np.bincount(self.text, minlength=len(column))
        self.starts = np.cumsum(self.counts) - self.counts

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value of each element over each set."""
        total = np.append(np.uint64(0), np.cumsum(values))
        return total[self.starts + self.counts] - total[self.starts]

    def sketches(self) -> pa.Array:
        """Numbers of elements in cells, about four a cell; a power of two of cells, a byte each."""
        level = np.ceil(np.log2(np.maximum(self.counts, 1) / 4)).clip(_CELLS).astype(np.int64)
        stops = np.cumsum(1 << level)
        cell = mix(self.hash ^ _STEP) >> (np.uint64(64) - level.astype(np.uint64))[self.text]
        place = (stops - (1 << level))[self.text] + cell.astype(np.int64)
        cells = np.bincount(place, minlength=int(stops[-1])).clip(max=255).astype(np.uint8)
        offsets = np.append(0, stops).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(level), [None, pa.py_buffer(offsets), pa.py_buffer(cells)])

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that tell a set."""
        return self.sums(mix(self.hash + _ONE)), self.sums(mix(self.hash ^ np.uint64(_BASE)))


@cache
def _bands(percent: int, most: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """First sizes of the bands up to ``most``, and how many parts each has."""
    first = [1, 2]
    while first[-1] <= most:
        first.append(max(first[-1] + 1, (first[-1] - 1) * 100 // percent + 1))
    first.append(max(first[-1] + 1, (first[-1] - 1) * 100 // percent + 1))
    parts = []
    for i in range(len(first) - 1):
        k = 2 * (first[i + 1] - 1) * (100 - percent) // (100 + percent)
        smallest = first[max(0, i - 1)]
        x = 0
        while True:
            n = k // 2 + 1 + x
            empty = math.exp(-smallest / (3 * n))
            poor = n * (3 * empty ** 2 - 2 * empty ** 3)
            if x >= poor + 3 * math.sqrt(poor) or x > k // 2 + 3:
                break
            x += 1
        parts.append(n)
    return tuple(first), tuple(parts)


def _signatures(sets: _Sets, which: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of some sets, and the set that each belongs to."""
    sizes = sets.counts
    first, parts = (np.array(x) for x in _bands(percent, int(sizes.max(initial=1))))
    band_of = np.searchsorted(first, sizes, side="right") - 1
    use = np.zeros(len(sizes), bool)
    use[which] = sizes[which] > 0
    element = np.flatnonzero(use[sets.text])
    text, h = sets.text[element], sets.hash[element]
    found: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    for higher in (0, 1):
        band = band_of + higher
        count = np.where(use, parts[np.minimum(band, len(parts) - 1)], 0)
        salt = mix(np.arange(len(first) + 1).astype(np.uint64) + np.uint64(977))[band]
        value = mix(h ^ salt[text])
        part = ((value >> np.uint64(32)) * (3 * count[text]).astype(np.uint64)) >> np.uint64(32)
        base = np.cumsum(count) - count
        slot = 3 * base[text] + part.astype(np.int64)
        order = np.argsort(slot, kind="stable")
        slots, begin = np.unique(slot[order], return_index=True)
        content = np.zeros(3 * int(count.sum()), np.uint64)
        filled = np.zeros(len(content), bool)
        if len(begin):
            content[slots] = np.add.reduceat(mix(value[order]), begin)
            filled[slots] = True
        content, filled = content.reshape(-1, 3), filled.reshape(-1, 3)
        owner = np.repeat(np.arange(len(sizes)), count)
        place = np.arange(len(owner)) - base[owner]
        # spare parts: n - k // 2 - 1
        k = 2 * (first[np.minimum(band + 1, len(first) - 1)] - 1) * (100 - percent) // (100 + percent)
        poor = np.bincount(owner[filled.sum(axis=1) < 2], minlength=len(sizes))
        all_of = (poor > count - k // 2 - 1)[owner]
        for i, (one, two) in enumerate(((0, 1), (0, 2), (1, 2))):
            keep = filled[:, one] | filled[:, two] | all_of
            name = mix(salt[owner[keep]] + (3 * place[keep] + i).astype(np.uint64))
            found.append(mix(mix(content[keep, one] + name) + content[keep, two]))
            owners.append(owner[keep])
    return np.concatenate(found), np.concatenate(owners)


def _members(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n, rep, sketch``: size of each set, the least id with the same set (null if empty), its sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = _Sets(part.column("text"), size)
            keys = [pa.array(k.view(np.int64)) for k in sets.keys()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sets.counts.astype(np.int64)), *keys, sets.sketches()],
                ["doc_id", "n", "k1", "k2", "sketch"])

    keyed = stage(docs.mapInArrow(run, "doc_id bigint, n bigint, k1 bigint, k2 bigint, sketch binary"), "sets")
    key = ["n", "k1", "k2"]
    reps = keyed.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    none = F.lit(None)
    return stage(keyed.where("n > 0").join(reps, key).select(
        "doc_id", "n", "rep", F.when(F.col("doc_id") == F.col("rep"), F.col("sketch")).alias("sketch")).unionByName(
        keyed.where("n = 0").select("doc_id", "n", none.cast("bigint").alias("rep"),
                                    none.cast("binary").alias("sketch"))), "members")


def _candidates(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b``: links that make one cluster of all sets that share a signature.

    A task joins up what it has in a slice itself and sends one row per signature on. Of
    equal sets in a slice the least id stands for all; the least id of the table is
    always among them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = _Sets(part.column("text"), size)
            doc = part.column("doc_id").to_numpy()
            order = np.lexsort((doc, *sets.keys()))
            keys = np.column_stack(sets.keys())[order]
            new = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
            signature, owner = _signatures(sets, order[new], percent)
            order = np.lexsort((doc[owner], signature))
            signature, owner = signature[order], doc[owner[order]]
            head = np.append(True, signature[1:] != signature[:-1]) if len(order) else np.zeros(0, bool)
            lead = owner[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
            links = np.column_stack([lead, owner])[~head]
            links = np.column_stack(forest(links[:, 0], links[:, 1])) if len(links) else links
            alone = mix(links[:, 0].astype(np.uint64) + np.uint64(_BASE))  # spread over the tasks
            k = np.concatenate([signature[head], alone])
            a = np.concatenate([owner[head], links[:, 0]])
            b = np.concatenate([np.zeros(int(head.sum()), np.int64), links[:, 1]])
            local = np.arange(len(k)) < int(head.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(k.view(np.int64)), pa.array(a), pa.array(b, mask=local)], ["k", "a", "b"])

    rows = docs.mapInArrow(run, "k bigint, a bigint, b bigint")
    first = F.first("a").over(Window.partitionBy("k", F.col("b").isNull()).orderBy("a"))
    return rows.withColumn("first", first).select("a", F.coalesce("b", "first").alias("b")) \
        .where("a <> b").distinct()


def _possible(table: pa.Table, percent: int) -> pa.Table:
    """``doc_id, part`` of the sets of two blocks (or one) that may have a link; those of one part hang together."""
    doc, n, block = (table.column(c).to_numpy() for c in ("doc_id", "n", "block"))
    left = block == block.min()  # a group has a row at least
    cross = not left.all()
    order = np.lexsort((doc, n, ~left))
    doc, n, left = doc[order], n[order], left[order]
    raw = table.column("sketch").combine_chunks().take(pa.array(order)).to_pylist()
    level = np.array([len(r).bit_length() - 1 for r in raw])
    levels = np.unique(level).tolist()
    rows, cells = {}, {}  # by level: sets of as many cells or more, and their sketches with as many
    for low in levels:
        rows[low] = np.flatnonzero(level >= low)
        table_of = np.zeros((len(rows[low]), 1 << low), np.uint8)
        for i, r in enumerate(rows[low].tolist()):
            own = np.frombuffer(raw[r], np.uint8).reshape(1 << low, -1)
            table_of[i] = own.sum(axis=1).clip(max=255)
        cells[low] = table_of
    group = np.arange(len(doc))
    for i in np.flatnonzero(left).tolist():
        for low in levels:
            if low > level[i]:
                break
            mine = rows[low]
            able = (group[mine] != group[i]) & (~left[mine] if cross else mine > i)
            able &= 100 * np.minimum(n[mine], n[i]) >= percent * np.maximum(n[mine], n[i])
            if low < level[i]:
                able &= level[mine] == low
            at = np.flatnonzero(able)
            if not len(at):
                continue
            x, y = cells[low][at], cells[low][np.searchsorted(mine, i)]
            apart = (np.maximum(x, y) - np.minimum(x, y)).sum(axis=1, dtype=np.int64)
            hit = mine[at[apart * (100 + percent) <= (n[mine[at]] + n[i]) * (100 - percent)]]
            if len(hit):
                group[np.isin(group, np.append(group[hit], group[i]))] = group[i]
    _, part, size = np.unique(group, return_inverse=True, return_counts=True)
    least = np.full(len(size), np.iinfo(np.int64).max)
    np.minimum.at(least, part, doc)
    use = size[part] > 1
    return pa.table([pa.array(doc[use]), pa.array(least[part][use]), pa.array(left[use])], ["doc_id", "part", "one_side"])


def _verified(docs: DataFrame, members: DataFrame, clusters: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b``: a spanning forest of the links between sets of a cluster that reach the threshold."""
    reps = members.where("doc_id = rep").select("doc_id", "n", "sketch")
    placed = stage(reps.join(clusters, F.col("doc_id") == F.col("node")).select(
        "doc_id", "n", "component", "sketch"), "placed")
    # sets in the order of size, equal sizes in that of a hash, cut where another BLOCK elements begin
    sizes = placed.groupBy("component", "n").agg(F.count("*").alias("sets"))
    whole = Window.partitionBy("component")
    before = F.sum(F.col("n") * F.col("sets")).over(whole.orderBy("n")) - F.col("n") * F.col("sets")
    sizes = sizes.withColumn("before", before).withColumn("all", F.sum("sets").over(whole)).where("all > 1")
    place = F.col("before") + F.col("n") * F.pmod(F.xxhash64("doc_id"), F.col("sets"))
    blocked = stage(placed.join(sizes, ["component", "n"]).select(
        "doc_id", "n", "component", "sketch", F.floor(place / BLOCK).cast("bigint").alias("block")), "blocked")
    blocks = stage(blocked.groupBy("component", "block").agg(F.min("n").alias("low"), F.max("n").alias("high")), "blocks")
    other = blocks.select("component", F.col("block").alias("block2"), F.col("low").alias("low2"))
    pairs = blocks.join(other, "component").where(
        (F.col("block2") >= F.col("block")) & (100 * F.col("high") >= percent * F.col("low2"))) \
        .select("component", "block", "block2")
    sides = pairs.select("component", F.col("block").alias("one"), F.col("block2").alias("two"), F.explode(
        F.array_distinct(F.array("block", "block2"))).alias("block"))
    task = ["component", "one", "two"]

    def possible(key: tuple, table: pa.Table) -> pa.Table:
        found = _possible(table, percent)
        for name, value in zip(task, key):
            found = found.append_column(name, pa.array([value.as_py()] * found.num_rows, pa.int64()))
        both = key[1].as_py() != key[2].as_py()
        return found.append_column("cross", pa.array([both] * found.num_rows, pa.bool_()))

    tasks = stage(blocked.join(sides, ["component", "block"]).groupBy(*task).applyInArrow(
        possible, "doc_id bigint, part bigint, one_side boolean, component bigint, one bigint, two bigint, cross boolean"),
        "tasks")
    # texts meet their tasks by id in the same way whatever the size
    rows = docs.hint("merge").join(tasks, "doc_id")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        doc = table.column("doc_id").to_numpy()
        left = table.column("one_side").to_numpy()
        cross = table.column("cross")[0].as_py()  # a group has a row at least
        text = table.column("text").chunk(0)
        sets = _Sets(text, size)
        _, code = np.unique(sets.hash, return_inverse=True)
        marks = np.zeros(int(code.max(initial=-1)) + 1, bool)
        counts, starts = sets.counts, sets.starts
        group = np.arange(len(doc))
        links: list[tuple[int, int]] = []
        for i in np.argsort(doc).tolist():
            if cross and not left[i]:
                continue
            # a pair within reach of size, of the other block or later, and not linked yet
            able = (group != group[i]) & (100 * np.minimum(counts, counts[i]) >= percent * np.maximum(counts, counts[i]))
            if cross:
                able &= ~left
            if not able.any():
                continue
            mine = code[starts[i]:starts[i] + counts[i]]
            marks[mine] = True
            sums = np.append(0, np.cumsum(marks[code]))
            marks[mine] = False
            shared = sums[starts + counts] - sums[starts]
            hit = np.flatnonzero(able & (100 * shared >= percent * (counts + counts[i] - shared)))
            for g in np.unique(group[hit]).tolist():
                links.append((i, int(hit[group[hit] == g][0])))
            group[np.isin(group, np.append(group[hit], group[i]))] = group[i]
        a = doc[[x for x, _ in links]] if links else np.zeros(0, np.int64)
        b = doc[[y for _, y in links]] if links else np.zeros(0, np.int64)
        return pa.table([pa.array(a), pa.array(b)], ["a", "b"])

    return rows.groupBy(*task, "part").applyInArrow(compare, "a bigint, b bigint")


def similarity_components(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` under links of Jaccard similarity of ``percent`` or more.

    A text's set are its distinct sequences of ``size`` words, with A-Z in lower case; a
    shorter text is one sequence, an empty or null one has an empty set and no links.
    Of rows that repeat an id the one with the least text counts, rows without id go.
    The component is the least id reachable by links.
    """
    docs = one_per_id(documents(docs, id_col, text_col))
    members = _members(docs, size)
    clusters = components(stage(_candidates(docs, size, percent), "candidates"))
    # a cluster is known by texts; copies of a set count through the least id
    named = stage(clusters, "clusters")
    found = components(stage(_verified(docs, members, named, size, percent), "verified"))
    joined = members.join(found, F.col("rep") == F.col("node"), "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"),
                         F.coalesce("component", "rep", "doc_id").alias("component_id"))

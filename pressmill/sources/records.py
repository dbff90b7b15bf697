"""Delimited records of large files whose quoted fields may span lines, read block by block.

Spark's text source cuts a file into blocks that begin at a line. Whether a block begins inside
a quoted field depends on all that is before it, so files are read twice:

1. Every block tells in which state it ends if it begins outside, and if it begins inside a
   quoted field, and whether a record ends in it. Going through these few rows in
   order, one per block, gives the state in which each block really begins.
2. Every block is cut into records. They soon are the same from either state; those
   before that are told by the state that was found. Complete records stay where they are; a record that goes on in the next blocks is put together from its pieces, of
   which there are two per block at most.

So a file of any size is read by as many tasks as it has blocks, and what passes between
the two steps is one short row per block, about a millionth of the file.

Quotes follow the rules of Spark's own reader: a quote opens a field only at its
beginning, two are a quote, and one that neither ends the field nor is doubled makes
the field an unquoted one up to the next separator.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressmill.session import materialize

_LF, _CR, _QUOTE = 10, 13, 34


def _quoted_spans(data: np.ndarray, inside: bool, sep: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Where quoted stretches begin and end in whole lines, and whether the last one is still open.

    ``data`` begins at a line and ends with a line end; ``inside`` tells its state at first.
    """
    at = np.flatnonzero(data == _QUOTE)
    before, after = data[np.maximum(at - 1, 0)], data[at + 1]  # there is a line end behind every quote
    opening = np.arange(len(at)) % 2 == int(inside)
    doubled = np.diff(at) == 1
    begins_field = (before == sep) | (before == _LF) | (at == 0) | np.append(False, doubled)[:len(at)]
    ends_field = (after == sep) | (after == _LF) | (after == _CR) | np.append(doubled, False)[:len(at)]
    if np.where(opening, begins_field, ends_field).all():  # then every other quote opens
        begin, end = at[opening], at[~opening]
    else:
        begin, end = (np.array(x, np.int64) for x in _walk(data, at.tolist(), inside, sep))
    if inside:
        begin = np.append(0, begin)
    still = len(begin) > len(end)
    return begin, np.append(end, len(data)) if still else end, still


def _walk(data: np.ndarray, quotes: list[int], inside: bool, sep: int) -> tuple[list[int], list[int]]:
    """The same one quote after another, for text with quotes that neither begin nor end a field."""
    begin, end, skip = [], [], -1
    for p in quotes:
        if p == skip:
            continue
        if not inside:
            if p == 0 or data[p - 1] in (sep, _LF):
                begin.append(p)
                inside = True
            continue
        if data[p + 1] == _QUOTE:
            skip = p + 1
            continue
        # the field ends here, or goes on as an unquoted one
        end.append(p)
        inside = False
    return begin, end


def cut(data: np.ndarray, inside: bool, sep: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Positions behind the record ends of whole lines, of the separators, and the last state."""
    begin, end, still = _quoted_spans(data, inside, sep)

    def outside(at: np.ndarray) -> np.ndarray:
        if not len(begin):
            return at
        i = np.searchsorted(begin, at, side="right") - 1
        return at[(i < 0) | (at >= end[i])]

    return outside(np.flatnonzero(data == _LF)) + 1, outside(np.flatnonzero(data == sep)), still


def _text(record: bytes) -> str:
    return record.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace")


def _rows(records: list[bytes], sep: int, fields: list[int] | None = None) -> pa.RecordBatch:
    """Text and number of fields of whole records, without the empty ones."""
    if fields is None:
        fields = [len(cut(np.frombuffer(r + b"\n" * (not r.endswith(b"\n")), np.uint8), False, sep)[1]) + 1 for r in records]
    kept = [(t, n) for t, n in zip(map(_text, records), fields) if t]
    return pa.RecordBatch.from_arrays([pa.array([t for t, _ in kept], pa.string()),
                                       pa.array([n for _, n in kept], pa.int32())], ["record", "fields"])


def _lines(column: pa.Array) -> np.ndarray:
    """Lines (bytes) one after another, a line end behind each."""
    return np.frombuffer(b"\n".join(column.to_pylist()) + b"\n", np.uint8)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Parts of the batches that belong to one block, with its file and start."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column("file").to_pylist(), batch.column("start").to_numpy()
        change = [0, *(i for i in range(1, len(file)) if start[i] != start[i - 1] or file[i] != file[i - 1]), len(file)]
        for a, b in zip(change, change[1:]):
            yield (file[a], int(start[a])), batch.slice(a, b - a)


class _Reading:
    """One block, read line by line from one of the two states it may begin in."""

    def __init__(self, inside: bool) -> None:
        self.inside, self.ended, self.head, self.tail = inside, False, b"", b""

    def take(self, data: np.ndarray, sep: int) -> None:
        ends, _, self.inside = cut(data, self.inside, sep)
        if not len(ends):
            self.tail += data.tobytes()
            return
        if not self.ended:
            self.head, self.ended = self.tail + data[:ends[0]].tobytes(), True
        self.tail = data[ends[-1]:].tobytes()

    def same_as(self, other: _Reading) -> bool:
        return self.ended and other.ended and (self.inside, self.tail) == (other.inside, other.tail)


def _blocks(lines: DataFrame, sep: int) -> DataFrame:
    """``file, start, inside, pieces``: the state in which each block begins, and the pieces of records it
    shares with other blocks, each with the block in which the record begins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, outer, inner, met = None, None, None, False

        def row() -> pa.RecordBatch:
            # without an end the whole block is the tail of one record, or the middle of another
            return pa.RecordBatch.from_pylist([{
                "file": here[0], "start": here[1], "out": outer.inside, "in": inner.inside, "ended_in": inner.ended,
                "head_in": inner.head if inner.ended else inner.tail, "tail_out": outer.tail,
                "tail_in": inner.tail if inner.ended else b""}], names)

        names = pa.schema([("file", pa.string()), ("start", pa.int64()), ("out", pa.bool_()), ("in", pa.bool_()),
                           ("ended_in", pa.bool_()), ("head_in", pa.binary()), ("tail_out", pa.binary()),
                           ("tail_in", pa.binary())])
        for key, part in _by_block(batches):
            if here != key:
                if here is not None:
                    yield row()
                here, outer, inner, met = key, _Reading(False), _Reading(True), False
            data = _lines(part.column("value"))
            outer.take(data, sep)
            if met:  # both readings are one from here on
                inner.inside, inner.tail = outer.inside, outer.tail
            else:
                inner.take(data, sep)
                met = inner.same_as(outer)
        if here is not None:
            yield row()

    found = materialize(lines.mapInArrow(
        run, "file string, start bigint, out boolean, in boolean, ended_in boolean, head_in binary, "
             "tail_out binary, tail_in binary"), "blocks")
    # A block that ends alike from both states decides; the others keep the state or turn it.
    order = Window.partitionBy("file").orderBy("start")
    decides = F.col("out") == F.col("in")
    # Only the states go through the window; the pieces of text stay with their blocks.
    runs = found.select("file", "start", "out", "in", "ended_in").withColumn("run", F.sum(decides.cast("int")).over(order))
    turned = F.sum(F.when(~decides & F.col("out"), 1).otherwise(0)).over(Window.partitionBy("file", "run").orderBy("start"))
    first = F.coalesce(F.max(F.when(decides, F.col("out"))).over(Window.partitionBy("file", "run")), F.lit(False))
    after = runs.withColumn("after", (first.cast("int") + turned) % 2 == 1)
    placed = after.withColumn("inside", F.coalesce(F.lag("after").over(order), F.lit(False)))
    begins = F.when(~F.col("inside") | F.col("ended_in"), F.col("start"))  # a record begins in it, perhaps at its end
    owner = F.last(begins, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    states = placed.select("file", "start", "inside", owner.alias("owner"))
    piece = [F.struct("owner", F.when(F.col("inside"), F.col("head_in")).alias("piece")),
             F.struct(F.col("start").alias("owner"),
                      F.when(F.col("inside"), F.col("tail_in")).otherwise(F.col("tail_out")).alias("piece"))]
    return materialize(found.join(states, ["file", "start"]).select("file", "start", "inside", F.filter(
        F.array(*piece), lambda p: F.length(p["piece"]) > 0).alias("pieces")), "blocks")


class _Cutter:
    """Complete records of one block, if it begins in the given state."""

    def __init__(self, inside: bool) -> None:
        self.inside, self.skip, self.rest = inside, inside, b""  # the first end may be that of an earlier record

    def take(self, data: np.ndarray, sep: int) -> dict[tuple[int, int], tuple[bytes, int]]:
        """Records that end here by where they begin and end, with their number of fields."""
        ends, seps, self.inside = cut(data, self.inside, sep)
        if not len(ends):
            self.rest += data.tobytes()
            return {}
        text, stops = data[:ends[-1]].tobytes(), ends.tolist()
        fields = (np.diff(np.append(0, np.searchsorted(seps, ends))) + 1).tolist()
        found = {(a, b): (text[a:b], n) for a, b, n in zip([0, *stops], stops, fields)}
        if self.skip or self.rest:
            first, _ = found.pop((0, stops[0]))
            if not self.skip:
                record = self.rest + first
                _, inner, _ = cut(np.frombuffer(record, np.uint8), False, sep)
                found[-len(self.rest), stops[0]] = record, len(inner) + 1
        self.skip, self.rest = False, data[ends[-1]:].tobytes()
        return found

    def same_as(self, other: _Cutter) -> bool:
        return not self.skip and not other.skip and (self.inside, len(self.rest)) == (other.inside, len(other.rest))


def read_records(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """``record, fields``: each record as text, without its line end, and its number of fields.

    Bytes that are no UTF-8 arrive as U+FFFD. A carriage return before a line end belongs to
    the line end. Empty lines are left out.
    """
    code = ord(sep)
    source = spark.read.option("lineSep", "\n").text(list(path) if not isinstance(path, str) else path)
    lines = source.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                          F.col("_metadata.file_block_start").alias("start"))
    blocks = _blocks(lines, code)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, cutters, met = None, [], False

        def rows(found: dict, if_inside: bool | None) -> pa.RecordBatch:
            batch = _rows([r for r, _ in found.values()], code, [n for _, n in found.values()])
            n = batch.num_rows
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([here[0]] * n, pa.string()), pa.array([here[1]] * n, pa.int64()),
                 pa.array([if_inside] * n, pa.bool_())], ["record", "fields", "file", "start", "if_inside"])

        for key, part in _by_block(batches):
            if here != key:
                here, cutters, met = key, [_Cutter(False), _Cutter(True)], False
            data = _lines(part.column("value"))
            outer, *inner = [c.take(data, code) for c in cutters[:1 if met else 2]]
            if met:
                yield rows(outer, None)
                continue
            same = outer.keys() & inner[0].keys()
            yield rows({k: outer[k] for k in same}, None)
            yield rows({k: r for k, r in outer.items() if k not in same}, False)
            yield rows({k: r for k, r in inner[0].items() if k not in same}, True)
            met = cutters[0].same_as(cutters[1])

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows([b"".join(p["piece"] for p in parts) for parts in batch.column("parts").to_pylist()], code)

    kind = "record string, fields int"
    # what a block has from either state; the few records that depend on it are then told by the state
    either = lines.mapInArrow(run, f"{kind}, file string, start bigint, if_inside boolean")
    whole = either.join(blocks.select("file", "start", "inside"), ["file", "start"]).where(
        F.coalesce(F.col("if_inside") == F.col("inside"), F.lit(True))).select("record", "fields")
    shared = blocks.select("file", "start", F.explode("pieces").alias("p")).groupBy("file", "p.owner").agg(
        F.array_sort(F.collect_list(F.struct("start", "p.piece"))).alias("parts"))
    every = whole.unionByName(shared.select("parts").mapInArrow(put_together, kind))
    return every.withColumn("record", F.regexp_replace("record", "^\uFEFF", ""))

"""Hinge-loss training in epochs of single steps over rows in a seeded order.

Rows are dealt by a hash of their id into parts. In each epoch every part goes through its
rows in a new order, one step a row with a decaying length, from the same coefficients; their
results are averaged, weighted by rows, and the next epoch starts there. One part is plain
stochastic descent. The order depends on ids, seed and epoch alone, so a run that is
repeated after a lost executor makes the same steps.

The coefficients, one per term of the vocabulary (``max_features`` bounds it), are a vector in
each task; the averages of an epoch come back as one row per term that was changed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVCModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.operators.features import class_weights
from pressmill.operators.linear import model_of
from pressmill.session import materialize

#: Rows that one part holds about.
PART_ROWS = 50_000


class Steps:
    """Coefficients and intercept that move by one step a row.

    The step length is ``1 / (alpha * (t0 + t))`` after ``t`` rows, ``t0`` being chosen so that the
    first step moves a coefficient by about the size expected of it. The factor all
    coefficients shrink by is kept apart, so a step touches only the terms of its row.
    """

    def __init__(self, coefficients: np.ndarray, intercept: float, alpha: float, done: int) -> None:
        self.w, self.b, self.alpha, self.scale = coefficients.copy(), intercept, alpha, 1.0
        typical = math.sqrt(1.0 / math.sqrt(alpha))
        self.t0 = 1.0 / (typical * alpha)
        self.t = done

    def take(self, indices: np.ndarray, values: np.ndarray, sign: float, weight: float) -> None:
        length = 1.0 / (self.alpha * (self.t0 + self.t))
        self.t += 1
        margin = sign * (self.scale * float(self.w[indices] @ values) + self.b)
        self.scale *= max(0.0, 1.0 - length * self.alpha)
        if self.scale < 1e-9:
            self.w *= self.scale
            self.scale = 1.0
        if margin < 1:
            push = length * weight * sign
            self.w[indices] += push / self.scale * values
            self.b += push * 0.01  # terms are rare, the intercept is in every row

    def coefficients(self) -> np.ndarray:
        return self.w * self.scale


def first_rows_class_weights(df: DataFrame, rows: int = 100_000, label: str = "label", id_column: str = "id",
                             seed: int = C.SEED) -> dict[int, float]:
    """Balanced class weights counted on the first rows in the seeded order, as incremental training takes them."""
    from pressmill.operators.sampling import fixed_size_sample

    first = fixed_size_sample(df.select(id_column, label), rows, id_column, seed)
    return {r["label"]: r["class_weight"] for r in class_weights(first, label).collect()}


def _dealt(vectors: DataFrame, parts: int, epoch: int, label: str, id_column: str, seed: int) -> DataFrame:
    part = F.pmod(F.xxhash64(F.lit(seed), id_column), F.lit(parts)).cast("int")
    order = F.xxhash64(F.lit(seed + 1 + epoch), id_column)
    rows = vectors.select(part.alias("part"), order.alias("place"), F.col(id_column).alias("id"),
                          F.col(label).cast("int").alias("label"), "indices", "values")
    return rows.repartition(parts, "part").sortWithinPartitions("part", "place", "id").drop("place", "id")


def train_epochs(rows: DataFrame, size: int, alpha: float = C.SVM_ALPHA, epochs: int = C.SVM_EPOCHS,
                 weights: Mapping[int, float] | None = None, parts: int | None = None, label: str = "label",
                 id_column: str = "id", seed: int = C.SEED) -> tuple[np.ndarray, float]:
    """Coefficients and intercept after ``epochs`` passes.

    ``rows`` is a table of ``linear.sparse_rows`` with labels 0 and 1, ``size`` its number of
    terms. ``weights`` defaults to balanced class weights of the first 100,000 rows.
    """
    if weights is None:
        weights = first_rows_class_weights(rows, label=label, id_column=id_column, seed=seed)
    given = {int(k): float(v) for k, v in weights.items()}
    flat = materialize(rows.select(id_column, label, F.col("features.indices").alias("indices"),
                                   F.col("features.values").alias("values")), "rows")
    parts = parts or max(1, math.ceil(flat.count() / PART_ROWS))
    coefficients, intercept, done = np.zeros(size), 0.0, 0
    for epoch in range(epochs):
        start = coefficients, intercept, done

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here, steps, taken = None, None, 0

            def result() -> pa.RecordBatch:
                w = steps.coefficients()
                at = np.flatnonzero(w != start[0])
                # rows, then intercept, then changed coefficients
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.append([-2, -1], at).astype(np.int64)),
                     pa.array(np.append([1.0, steps.b - start[1]], w[at] - start[0][at]) * taken)], ["idx", "sum"])

            for batch in batches:
                part = batch.column("part").to_numpy()
                signs = batch.column("label").to_numpy().astype(float) * 2 - 1
                indices, values = batch.column("indices"), batch.column("values")
                for i in range(batch.num_rows):
                    if part[i] != here:
                        if here is not None:
                            yield result()
                        here, steps, taken = part[i], Steps(start[0], start[1], alpha, start[2]), 0
                    steps.take(indices[i].values.to_numpy(), values[i].values.to_numpy(), signs[i],
                               given.get(int(signs[i] > 0), 1.0))
                    taken += 1
            if here is not None:
                yield result()

        dealt = _dealt(flat, parts, epoch, label, id_column, seed)
        moved = dealt.mapInArrow(run, "idx bigint, sum double").groupBy("idx").agg(F.sum("sum").alias("sum")).toArrow()
        sums = dict(zip(moved.column("idx").to_pylist(), moved.column("sum").to_pylist()))
        total = sums.pop(-2, 0.0)
        if not total:
            break
        intercept += sums.pop(-1) / total
        at = np.fromiter(sums, np.int64, len(sums))
        coefficients[at] += np.fromiter(sums.values(), float, len(sums)) / total
        done += math.ceil(total / parts)
    return coefficients, intercept


def hinge_objective(rows: DataFrame, coefficients: np.ndarray, intercept: float, weights: Mapping[int, float],
                    alpha: float = C.SVM_ALPHA, label: str = "label") -> float:
    """Weighted mean hinge loss plus ``alpha / 2 * |w|^2``; 1 for coefficients that are all zero."""
    given = {int(k): float(v) for k, v in weights.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("label").to_numpy()
            spread = np.repeat(np.arange(len(y)), batch.column("indices").value_lengths().to_numpy())
            products = coefficients[batch.column("indices").flatten().to_numpy()] * batch.column("values").flatten().to_numpy()
            margin = (2 * y - 1) * (np.bincount(spread, products, len(y)) + intercept)
            weight = np.array([given.get(int(v), 1.0) for v in y])
            yield pa.RecordBatch.from_arrays([pa.array([float((weight * np.maximum(0, 1 - margin)).sum())]),
                                              pa.array([float(weight.sum())])], ["loss", "weight"])

    flat = rows.select(F.col(label).cast("int").alias("label"), F.col("features.indices").alias("indices"),
                       F.col("features.values").alias("values"))
    loss, weight = flat.mapInArrow(run, "loss double, weight double").agg(F.sum("loss"), F.sum("weight")).first()
    return (loss / weight if weight else 0.0) + alpha / 2 * float(coefficients @ coefficients)


def fit_epochs(rows: DataFrame, size: int, **settings) -> LinearSVCModel:
    """The same as a model that ``linear.predict`` takes."""
    coefficients, intercept = train_epochs(rows, size, **settings)
    return model_of(rows.sparkSession, coefficients, intercept, logistic=False)

"""Coefficients as a table and training in epochs, against pyspark.ml and plain NumPy loops."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pressmill.operators import linear, linear_table, stochastic

TERMS = 40


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    x = rng.random((240, TERMS)) * (rng.random((240, TERMS)) < 0.2)
    x /= np.maximum(np.linalg.norm(x, axis=1), 1e-9)[:, None]
    truth = rng.normal(size=TERMS) * 3
    y = (x @ truth + rng.normal(size=240) > 0.2).astype(int)
    x[7] = 0  # a document without any known term
    return x, y


@pytest.fixture(scope="module")
def tables(spark, data):
    x, y = data
    cells = [(i, j, float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    return (spark.createDataFrame([(int(i), int(j), w) for i, j, w in cells], "id bigint, idx bigint, weight double"),
            spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "id bigint, label int"))


def objective(x, y, c, w, b):
    margin = (2 * y - 1) * (x @ w + b)
    return np.logaddexp(0, -margin).mean() + w @ w / (2 * c * len(y))


def dense(model, i):
    w = np.zeros(TERMS)
    for row in model.coefficients.collect():
        w[row["idx"]] = row[f"w{i}"]
    return w


@pytest.fixture(scope="module")
def fitted(tables):
    return linear_table.fit_grid(*tables, grid=(0.1, 10.0), tolerance=1e-3)


def test_same_minimum_as_ml(spark, data, fitted):
    x, y = data
    model = fitted
    frame = spark.createDataFrame([(float(v), Vectors.dense(r)) for r, v in zip(x, y)], ["label", "features"])
    for i, c in enumerate(model.grid):
        other = LogisticRegression(regParam=1 / (c * len(y)), standardization=False, tol=1e-10, maxIter=500).fit(frame)
        best = objective(x, y, c, other.coefficients.toArray(), other.intercept)
        mine = objective(x, y, c, dense(model, i), model.intercepts[i])
        assert abs(mine - best) < 1e-4 and abs(mine - model.objectives[i]) < 1e-9
        assert np.abs(dense(model, i) - other.coefficients.toArray()).max() < 0.02 * max(1, np.abs(dense(model, i)).max())


def test_scans_do_not_grow_with_the_grid(tables):
    one = linear_table.fit_grid(*tables, grid=(1.0,), max_iter=2, tolerance=1e-9)
    four = linear_table.fit_grid(*tables, grid=(0.01, 0.1, 1.0, 10.0), max_iter=2, tolerance=1e-9)
    assert four.passes == one.passes == 1 + 2 * 2


def test_candidates_do_not_depend_on_each_other(tables, fitted):
    alone = linear_table.fit_grid(*tables, grid=(0.1,), tolerance=1e-3)
    assert np.allclose(dense(alone, 0), dense(fitted, 0)) and math.isclose(alone.intercepts[0], fitted.intercepts[0])


def test_descent_equals_numpy(data, tables):
    x, y = data
    model = linear_table.descend(*tables, grid=(0.1, 1.0), steps=3, rate=0.7)
    for i, c in enumerate(model.grid):
        w, b = np.zeros(TERMS), 0.0
        for _ in range(3):
            r = (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
            w, b = w - 0.7 * (x.T @ r + w / (c * len(y))), b - 0.7 * r.sum()
        assert np.allclose(dense(model, i), w) and math.isclose(model.intercepts[i], b)
        assert math.isclose(model.objectives[i], objective(x, y, c, w, b))


def test_scores(data, tables, fitted):
    x, y = data
    model = fitted
    margin = x @ dense(model, 1) + model.intercepts[1]
    scored = {r["id"]: r for r in model.predict_probability(*tables, candidate=1).collect()}
    assert len(scored) == len(y)
    assert all(math.isclose(scored[i]["probability"], 1 / (1 + math.exp(-m))) for i, m in enumerate(margin.tolist()))
    guess = margin >= 0
    f1 = 2 * (guess & (y == 1)).sum() / (guess.sum() + (y == 1).sum())
    assert math.isclose(model.validation_f1(*tables)[1], f1)


def test_one_class_and_no_rows(spark, tables):
    cells, rows = tables
    only = linear_table.fit_grid(cells, rows.withColumn("label", F.lit(1)), grid=(1.0,), max_iter=2)
    assert only.objectives[0] < 0.3
    none = linear_table.fit_grid(cells.limit(0), rows, grid=(1.0,), max_iter=2)
    assert none.coefficients.count() == 0 and len(none.intercepts) == 1


# --- Epochs -------------------------------------------------------------------

def sparse(spark, data):
    x, y = data
    rows = [(i, int(y[i]), (0, TERMS, np.flatnonzero(x[i]).tolist(), x[i][x[i] != 0].tolist())) for i in range(len(y))]
    return spark.createDataFrame(rows, "id bigint, label int, features struct<type:int,size:int,indices:array<int>,values:array<double>>")


def plain_epochs(x, y, orders, weights, alpha):
    """Dense loop over rows in given orders, a list of parts per epoch."""
    w, b, done = np.zeros(x.shape[1]), 0.0, 0
    t0 = 1 / (alpha * math.sqrt(1 / math.sqrt(alpha)))
    for parts in orders:
        results = []
        for order in parts:
            v, a, t = w.copy(), b, done
            for i in order:
                eta, sign = 1 / (alpha * (t0 + t)), 2 * y[i] - 1
                late = sign * (x[i] @ v + a) < 1
                v *= 1 - eta * alpha
                if late:
                    v += eta * weights[y[i]] * sign * x[i]
                    a += eta * weights[y[i]] * sign * 0.01
                t += 1
            results.append((len(order), v, a))
        n = sum(r[0] for r in results)
        w, b = sum(r[0] * r[1] for r in results) / n, sum(r[0] * r[2] for r in results) / n
        done += math.ceil(n / len(parts))
    return w, b


@pytest.mark.parametrize("parts", [1, 3])
def test_epochs_equal_a_plain_loop(spark, data, parts):
    x, y = data
    rows = sparse(spark, data)
    weights = {0: 0.8, 1: 1.3}
    orders = []
    for epoch in range(3):
        where = rows.select("id", F.pmod(F.xxhash64(F.lit(42), "id"), F.lit(parts)).alias("p"),
                            F.xxhash64(F.lit(43 + epoch), "id").alias("o")).collect()
        orders.append([[r["id"] for r in sorted(where, key=lambda r: r["o"]) if r["p"] == p] for p in range(parts)])
    w, b = stochastic.train_epochs(rows, TERMS, alpha=1e-3, weights=weights, parts=parts)
    expected, intercept = plain_epochs(x, y, orders, weights, 1e-3)
    assert np.allclose(w, expected) and math.isclose(b, intercept)


def test_epochs_come_near_the_converged_model(spark, data):
    rows = sparse(spark, data)
    x, y = data
    near = stochastic.train_epochs(rows, TERMS, alpha=1e-2, epochs=6)
    assert ((x @ near[0] + near[1] > 0) == y).mean() > 0.8


def test_weights_of_first_rows(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    every = stochastic.first_rows_class_weights(rows)
    assert every == {0: 1000 / 1500, 1: 1000 / 500}
    some = stochastic.first_rows_class_weights(rows, 100)
    share = {k: 100 / (2 * v) for k, v in some.items()}
    assert math.isclose(sum(share.values()), 100) and some != every


def test_objective_and_epochs_without_rows(spark, data):
    rows = sparse(spark, data)
    x, y = data
    w, b = np.arange(TERMS) / 50.0, 0.3
    weight = np.where(y == 1, 2.0, 0.5)
    loss = (weight * np.maximum(0, 1 - (2 * y - 1) * (x @ w + b))).sum() / weight.sum() + 1e-4 / 2 * w @ w
    assert math.isclose(stochastic.hinge_objective(rows, w, b, {0: 0.5, 1: 2.0}), loss)
    w, b = stochastic.train_epochs(rows.limit(0), TERMS)
    assert not w.any() and b == 0

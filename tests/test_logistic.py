"""The logistic fit against its objective."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from pressmill.operators import linear, logistic

RARE = 240


@pytest.fixture(scope="module")
def rare(spark):
    """Three common terms; each other term is in one row."""
    def row(i):
        entries = {i % 3: 0.9, 3 + i: 0.5 + (i % 7) / 3}
        return i, int(i * i % 7 < 3), Vectors.sparse(RARE + 3, entries) if i % 5 else \
            Vectors.dense(Vectors.sparse(RARE + 3, entries).toArray())

    rows = spark.createDataFrame([row(i) for i in range(RARE)], ["id", "label", "features"]).repartition(5)
    data = rows.collect()
    return rows, np.array([r["features"].toArray() for r in data]), np.array([r["label"] for r in data])


def slope(x, y, w, b, c, n):
    residuals = (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
    return np.append(x.T @ residuals + w / (c * n), residuals.sum())


def test_rare_terms_need_few_passes(rare):
    rows, x, y = rare
    for c in (0.01, 10.0):
        model = linear.fit_logistic(rows, c, RARE, max_iter=25)
        now = np.linalg.norm(slope(x, y, model.coefficients.toArray(), model.intercept, c, RARE))
        assert now <= 2e-4 * np.linalg.norm(slope(x, y, np.zeros(RARE + 3), 0.0, c, RARE))


def test_candidates_share_passes(rare, monkeypatch):
    rows, x, y = rare
    passes = []
    products = logistic._Rows.products
    monkeypatch.setattr(logistic._Rows, "products", lambda self, a: passes.append(len(a)) or products(self, a))
    monkeypatch.setattr(logistic, "_BLOCK_CELLS", 7)
    monkeypatch.setattr(logistic, "_CHUNK_ROWS", 50)
    found = logistic.fit(rows, (0.1, 1.0), RARE + 3)
    assert passes[0] == 2 and len(passes) < 30
    for c, (w, b) in zip((0.1, 1.0), found):
        assert np.abs(slope(x, y, w, b, c, RARE)).max() < 1e-4


def test_weak_penalty_needs_few_passes(rare, monkeypatch):
    rows, x, y = rare
    passes = []
    products = logistic._Rows.products
    monkeypatch.setattr(logistic._Rows, "products", lambda self, a: passes.append(len(a)) or products(self, a))
    found = logistic.fit(rows, (0.1, 10.0, 1000.0), RARE + 3)
    assert len(passes) <= 14
    for c, (w, b) in zip((0.1, 10.0, 1000.0), found):
        now = np.linalg.norm(slope(x, y, w, b, c, RARE))
        assert now <= 2e-4 * np.linalg.norm(slope(x, y, np.zeros(RARE + 3), 0.0, c, RARE))


def test_few_vectors_suffice(rare, monkeypatch):
    rows, x, y = rare
    monkeypatch.setattr(logistic, "VECTORS", 6)
    monkeypatch.setattr(logistic, "_LEAST_VECTORS", 6)
    for c, (w, b) in zip((0.1, 10.0), logistic.fit(rows, (0.1, 10.0), RARE + 3)):
        now = np.linalg.norm(slope(x, y, w, b, c, RARE))
        assert now <= 2e-4 * np.linalg.norm(slope(x, y, np.zeros(RARE + 3), 0.0, c, RARE))


def test_blocks_number_rows_and_name_a_term_once(rare, monkeypatch):
    rows, x, y = rare
    monkeypatch.setattr(logistic, "_BLOCK_CELLS", 7)
    stored = logistic._Rows(rows, "label")
    rebuilt, seen = np.zeros((RARE, RARE + 3)), []
    for block in stored.blocks.collect():
        numbers, terms, lengths = (np.frombuffer(block[name], np.int32) for name in ("rows", "terms", "lengths"))
        seen += terms.tolist()
        rebuilt[numbers, np.repeat(terms, lengths)] = np.frombuffer(block["weights"], np.float64)
    assert sorted(seen) == list(range(RARE + 3))
    given = np.column_stack([x, y])[np.lexsort(x.T)]
    assert (np.column_stack([rebuilt, stored.y])[np.lexsort(rebuilt.T)] == given).all()


def test_one_class_and_no_rows(rare):
    rows, _, _ = rare
    for label, sign in ((0, -1), (1, 1)):
        model = linear.fit_logistic(rows.where(f"label = {label}"), 1.0, 10)
        assert model.intercept == sign * np.inf and not model.coefficients.toArray().any()
    with pytest.raises(ValueError, match="no training rows"):
        linear.fit_logistic(rows.where("id < 0"), 1.0, 10)

"""Linear baselines: hinge-loss SVM by ``pyspark.ml``, and logistic regression.

Logistic models are fitted by ``operators/logistic.py``; their coefficients are a table of terms, and
scores are joins with it (``TermModel``), so that nothing as long as the vocabulary is on the driver. The
coefficient vector of the SVM lives on the driver and in every task, so its length,
the vocabulary size, is what ``max_features`` of a field is there for. The only limit of the code is that of a vector: positions are 32-bit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import TypeVar

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.classification import (
    LinearSVC, LinearSVCModel, LogisticRegressionModel,
)
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseVector, Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill import constants as C
from pressmill.operators import logistic
from pressmill.operators.evaluation import confusion_matrix, metrics
from pressmill.operators.features import (
    Field, class_weights, fit_vocabulary, index_terms, term_weights,
)
from pressmill.session import materialize, stage_path

M = TypeVar("M")
_SPARSE = 0
_MAX_POSITIONS = (1 << 31) - 1  # of a vector


@dataclass(frozen=True)
class Vectorizer:
    """Fitted features: the indexed vocabulary and its size."""

    fields: tuple[Field, ...]
    vocabulary: DataFrame
    size: int

    def save(self, path: str) -> None:
        self.vocabulary.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, fields: Sequence[Field]) -> Vectorizer:
        vocabulary = spark.read.parquet(path)
        return cls(tuple(fields), vocabulary, vocabulary.count())


def load_or_fit_vectorizer(train: DataFrame, fields: Sequence[Field], path: str,
                           id_column: str = "id") -> Vectorizer:
    """The vectoriser saved at ``path``; fitted and saved there first if absent."""
    return load_or_fit(
        lambda: Vectorizer.load(train.sparkSession, path, fields),
        lambda: fit_vectorizer(train, fields, id_column),
        lambda fitted: fitted.save(path),
    )


def load_or_fit(load: Callable[[], M], fit: Callable[[], M], save: Callable[[M], None]) -> M:
    """Reuse a saved artefact; only a missing path leads to a new fit."""
    try:
        return load()
    except (AnalysisException, Py4JJavaError) as error:
        if not any(sign in str(error) for sign in ("PATH_NOT_FOUND", "does not exist")):
            raise
    fitted = fit()
    save(fitted)
    return fitted


def fit_vectorizer(train: DataFrame, fields: Sequence[Field],
                   id_column: str = "id") -> Vectorizer:
    """Vocabulary of the training documents with column positions."""
    vocabulary = fit_vocabulary(train, fields, id_column=id_column)
    size = vocabulary.count()
    if size > _MAX_POSITIONS:
        raise ValueError(f"{size} terms are more than a vector has positions")
    return Vectorizer(tuple(fields), materialize(index_terms(vocabulary), "term-index"), size)


def sparse_rows(df: DataFrame, vectorizer: Vectorizer, keep: Sequence[str] = ("id", "label"),
                id_column: str = "id") -> DataFrame:
    """``keep..., features``: one sparse row per document, empty ones included.

    ``features`` has the physical layout of a sparse vector: ``type, size,
    indices, values``. Only the terms of one document meet in one list.
    """
    weights = term_weights(df, vectorizer.vocabulary, vectorizer.fields, keep, id_column,
                           extra=["idx"], outer=True)
    entry = F.when(F.col("idx").isNotNull(), F.struct("idx", "weight"))
    entries = weights.groupBy(*keep).agg(F.sort_array(F.collect_list(entry)).alias("e"))
    return entries.select(*keep, F.struct(
        F.lit(_SPARSE).cast("tinyint").alias("type"),
        F.lit(vectorizer.size).cast("int").alias("size"),
        F.col("e.idx").alias("indices"),
        F.col("e.weight").alias("values"),
    ).alias("features"))


def vectorize(df: DataFrame, vectorizer: Vectorizer, keep: Sequence[str] = ("id", "label"),
              id_column: str = "id") -> DataFrame:
    """The same with ``features`` as ML vectors.

    Optimisers read the vectors many times, so they are written once. Reading
    the written rows back under the vector type builds the vectors without any
    Python. How many tasks a step has is up to the reader's settings.
    """
    rows = sparse_rows(df, vectorizer, keep, id_column)
    path = stage_path(df.sparkSession, "vectors")
    rows.write.mode("errorifexists").parquet(path)
    schema = T.StructType([
        *[rows.schema[c] for c in keep], T.StructField("features", VectorUDT()),
    ])
    return df.sparkSession.read.schema(schema).parquet(path)


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Add ``class_weight`` as a CASE over one literal per class."""
    per_class = {row["label"]: row["class_weight"] for row in class_weights(df, label).collect()}
    weight = F.lit(None).cast("double")
    for value, share in per_class.items():
        weight = F.when(F.col(label) == value, F.lit(share)).otherwise(weight)
    return df.withColumn("class_weight", weight)


def fit_svm(train: DataFrame, alpha: float = C.SVM_ALPHA, max_iter: int = 100,
            label: str = "label") -> LinearSVCModel:
    """Hinge loss plus ``alpha / 2 * |w|^2`` with balanced class weights."""
    estimator = LinearSVC(
        featuresCol="features", labelCol="_label", weightCol="class_weight",
        regParam=alpha, maxIter=max_iter, standardization=False,
    )
    return estimator.fit(
        with_class_weight(train, label).withColumn("_label", F.col(label).cast("double"))
    )


@dataclass(frozen=True)
class TermModel:
    """A linear model whose coefficients are a table ``idx, w``; terms that it lacks have 0."""

    terms: DataFrame
    intercept: float
    size: int
    logistic: bool = True

    @property
    def numFeatures(self) -> int:
        return self.size

    @property
    def coefficients(self) -> DenseVector:
        """All of them on the driver."""
        found, values = self.terms.toArrow(), np.zeros(self.size)
        values[found.column("idx").to_numpy()] = found.column("w").to_numpy()
        return Vectors.dense(values)

    def save(self, path: str) -> None:
        """As a model of the library, which passes the driver whole."""
        model_of(self.terms.sparkSession, self.coefficients.toArray(), self.intercept, self.logistic).save(path)


def margins(vectors: DataFrame, terms: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep...`` and the sum of products with each column of coefficients, under its name.

    ``terms`` has ``idx`` and the columns of coefficients. Rows need no id: they are numbered and written once.
    """
    names = [c for c in terms.columns if c != "idx"]
    stored = F.unwrap_udt("features")
    # a dense vector has values alone
    indices = F.when(stored["type"] == _SPARSE, stored["indices"]).otherwise(
        F.transform(stored["values"], lambda _, i: i))
    numbered = materialize(vectors.select(
        F.monotonically_increasing_id().alias("_row"), *keep, F.arrays_zip(
            indices.alias("idx"), stored["values"].alias("weight")).alias("_cells")), "numbered")
    cells = numbered.select("_row", F.inline("_cells").alias("idx", "weight"))
    sums = cells.join(terms, "idx").groupBy("_row").agg(
        *[F.sum(F.col("weight") * F.col(name)).alias(f"_{name}") for name in names])
    return numbered.select("_row", *keep).join(sums, "_row", "left").select(
        *keep, *[F.coalesce(f"_{name}", F.lit(0.0)).alias(name) for name in names])


def fit_logistic(train: DataFrame, c: float, rows: int, max_iter: int = C.LOGISTIC_MAX_ITER,
                 label: str = "label") -> TermModel:
    """L2-penalised logistic regression; ``c`` is the inverse penalty strength.

    ``rows`` is the number of training rows.
    """
    return _logistic_models(train, [c], max_iter, label, rows)[1][0]


def _logistic_models(train: DataFrame, grid: Sequence[float], max_iter: int,
                     label: str, rows: int | None = None) -> tuple[DataFrame, list[TermModel]]:
    """The coefficients of all as ``idx, w0, ...``, and each of the models."""
    first = train.select(F.unwrap_udt("features")["size"].alias("size"), "features").first()
    if first is None:
        raise ValueError("no training rows")
    size = first["size"] if first["size"] is not None else first["features"].size
    terms, intercepts = logistic.fit_terms(train, grid, max_iter, label=label, rows=rows)
    return terms, [TermModel(terms.select("idx", F.col(f"w{k}").alias("w")), b, size) for k, b in enumerate(intercepts)]


def predict(model, vectors: DataFrame, keep: Sequence[str] = ("id", "label")) -> DataFrame:
    """``keep..., prediction``."""
    if isinstance(model, TermModel):
        scored = margins(vectors, model.terms.withColumnRenamed("w", "_m"), keep)
        return scored.select(*keep, (F.col("_m") + model.intercept > 0).cast("int").alias("prediction"))
    return model.transform(vectors).select(*keep, F.col("prediction").cast("int"))


def predict_probability(model, vectors: DataFrame,
                        keep: Sequence[str] = ("id", "label"),
                        threshold: float = 0.5) -> DataFrame:
    """Logistic predictions by ``probability >= threshold``."""
    if isinstance(model, TermModel):
        scored = margins(vectors, model.terms.withColumnRenamed("w", "_m"), keep).select(
            *keep, _probability(F.col("_m") + model.intercept).alias("probability"))
    else:
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(vectors).select(
            *keep, F.get(vector_to_array("probability"), F.lit(1)).alias("probability")
        )
    return scored.withColumn("prediction", (F.col("probability") >= threshold).cast("int"))


def _probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def model_of(spark: SparkSession, coefficients, intercept: float, logistic: bool):
    """A model with the given coefficients, which ``predict`` takes like a fitted one."""
    values = _py2java(spark.sparkContext, Vectors.dense(coefficients))
    classes = spark._jvm.org.apache.spark.ml.classification
    if logistic:
        return LogisticRegressionModel(
            classes.LogisticRegressionModel("given", values, float(intercept)))
    return LinearSVCModel(classes.LinearSVCModel("given", values, float(intercept)))


def certificate(model, train: DataFrame, vectorizer: Vectorizer, loss: str,
                penalty: float = C.SVM_ALPHA, label: str = "label",
                id_column: str = "id") -> DataFrame:
    """Whether a fit is the minimum of its convex objective, from the table of weights.

    ``loss`` is ``hinge`` (balanced class weights) or ``log``. The objective is the mean
    loss plus ``penalty / 2 * |w|^2``, the intercept being free. One row: ``n_rows``,
    ``n_terms``; ``stationary``, the directional derivatives along the coefficients,
    the intercept and a fixed direction vanish (for the log loss the whole gradient is
    small against that at zero); ``lowest``, no scaled or shifted coefficients have a
    lower objective.
    """
    spark = train.sparkSession
    if isinstance(model, TermModel):
        coefficients = spark.range(model.size).select(F.col("id").cast("int").alias("idx")).join(
            model.terms, "idx", "left").select("idx", F.coalesce("w", F.lit(0.0)).alias("w"))
    else:
        values = model.coefficients.toArray()
        coefficients = spark.createDataFrame(pa.table({"idx": np.arange(len(values), dtype=np.int32), "w": values}))
    terms = materialize(coefficients.withColumn(
        "d", (F.pmod(F.xxhash64("idx"), F.lit(2001)) - 1000) / 1000.0), "coefficients")
    weights = materialize(term_weights(train, vectorizer.vocabulary, vectorizer.fields,
                                       (id_column, label), id_column, ["idx"])
                          .select(id_column, label, "idx", "weight"), "weights")
    dots = weights.join(terms, "idx").groupBy(id_column).agg(
        F.sum(F.col("weight") * F.col("w")).alias("m"), F.sum(F.col("weight") * F.col("d")).alias("e"))
    rows = train.select(id_column, label).join(dots, id_column, "left").select(
        id_column, F.col(label).cast("double").alias("y"), F.coalesce("m", F.lit(0.0)).alias("m"),
        F.coalesce("e", F.lit(0.0)).alias("e"))
    share = F.lit(1.0)
    if loss == "hinge":
        balanced = {r["label"]: r["class_weight"] for r in class_weights(train, label).collect()}
        share = F.when(F.col("y") == 1, balanced.get(1, 1.0)).otherwise(balanced.get(0, 1.0))
    rows = materialize(rows.withColumn("share", share), "margins")
    ww, wd, dd, n_terms = terms.agg(
        F.sum(F.col("w") * F.col("w")), F.sum(F.col("w") * F.col("d")),
        F.sum(F.col("d") * F.col("d")), F.count(F.lit(1))).first()
    b = float(model.intercept)
    unit = (ww / dd) ** 0.5 if dd else 0.0  # the direction, as long as the coefficients
    sign = 2 * F.col("y") - 1

    def loss_of(scale: float, along: float, shift: float):
        margin = sign * (scale * F.col("m") + along * F.col("e") + b + shift)
        # log(1 + exp(-x)) without overflow
        value = F.greatest(F.lit(0.0), 1 - margin) if loss == "hinge" else \
            F.greatest(F.lit(0.0), -margin) + F.log1p(F.exp(-F.abs(margin)))
        return F.sum(F.col("share") * value) / F.sum("share")

    moves = [(1.0, 0.0, 0.0)] + [
        (1.0 + x, y * unit, z * max(abs(b), 0.1))
        for s in (-1, 1) for x, y, z in ((0.1 * s, 0, 0), (0.3 * s, 0, 0), (0, 0.1 * s, 0), (0, 0, 0.3 * s),
                                         (0.1 * s, 0.1, 0.1), (-0.1, 0.1 * s, 0.1))]
    small = [(1 + 1e-3, 0, 0), (1 - 1e-3, 0, 0), (1, 0, 1e-3), (1, 0, -1e-3), (1, 1e-3 * unit, 0), (1, -1e-3 * unit, 0)]
    losses = rows.agg(F.count(F.lit(1)), *[loss_of(*move) for move in (*moves, *small)]).first()
    values = [value + penalty / 2 * (s * s * ww + 2 * s * a * wd + a * a * dd)
              for value, (s, a, _) in zip(losses[1:], (*moves, *small))]
    best, at_zero = values[0], 1.0 if loss == "hinge" else 0.6931471805599453
    lowest = all(value >= best - 1e-6 for value in values[1:len(moves)]) and best < at_zero
    # no small step gains more than the solver's tolerance
    stationary = all(value >= best - 1e-5 for value in values[len(moves):])
    if loss == "log":
        slope = 1 / (1 + F.exp(-(F.col("m") + b))) - F.col("y")
        residuals = weights.join(rows.select(id_column, slope.alias("r"), (0.5 - F.col("y")).alias("r0")), id_column)
        gradient = residuals.groupBy("idx").agg(
            (F.sum(F.col("weight") * F.col("r")) / losses[0]).alias("g"),
            (F.sum(F.col("weight") * F.col("r0")) / losses[0]).alias("g0")).join(terms, "idx")
        now, zero = gradient.agg(
            F.sum((F.col("g") + penalty * F.col("w")) ** 2), F.sum(F.col("g0") ** 2)).first()
        residual = rows.agg(F.abs(F.avg(slope))).first()[0]
        stationary = stationary and now <= 1e-4 * zero and residual < 1e-3
    return spark.createDataFrame([(losses[0], n_terms, stationary, lowest)],
                                 "n_rows bigint, n_terms bigint, stationary boolean, lowest boolean")


@dataclass(frozen=True)
class GridResult:
    model: TermModel | None
    best_c: float
    scores: tuple[tuple[float, float], ...]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, c, f1, c == self.best_c) for i, (c, f1) in enumerate(self.scores)]
        return spark.createDataFrame(rows, "position int, c double, f1 double, chosen boolean")


def validation_f1(predictions: DataFrame, pos_label: int = 1, label: str = "label") -> float:
    """F1 of one table of labels and predictions."""
    return metrics(confusion_matrix(predictions, pos_label=pos_label, label=label)).first()["f1"]


def choose(scores: Sequence[tuple[float, float]], models: Sequence | None = None) -> GridResult:
    """The candidate ``(c, f1)`` with the highest F1; the first wins a tie."""
    best = max(range(len(scores)), key=lambda i: scores[i][1])
    return GridResult(models[best] if models else None, float(scores[best][0]), tuple(scores))


def logistic_grid(train: DataFrame, validation: DataFrame,
                  grid: Sequence[float] = C.C_GRID, max_iter: int = C.LOGISTIC_MAX_ITER,
                  pos_label: int = 1, label: str = "label", parallelism: int = 1) -> GridResult:
    """Fit every ``c`` and keep the best validation F1; the first wins a tie.

    All candidates share the passes of the fit and one join that gives their margins; ``parallelism`` are scored
    at a time.
    """
    terms, models = _logistic_models(train, grid, max_iter, label)
    held = materialize(margins(validation, terms, (label,)), "margins")

    @inheritable_thread_target(train.sparkSession)
    def score(k: int) -> float:
        guess = (_probability(F.col(f"w{k}") + models[k].intercept) >= 0.5).cast("int")
        return validation_f1(held.select(label, guess.alias("prediction")), pos_label, label)

    with ThreadPool(max(1, min(parallelism, len(grid)))) as pool:
        scores = pool.map(score, range(len(grid)))
    return choose([(float(c), f1) for c, f1 in zip(grid, scores)], models)

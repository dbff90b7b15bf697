"""Multinomial naive Bayes over TF-IDF weights, entirely relational."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.constants import NB_ALPHA
from pressmill.operators.features import (
    Field, count_terms, fit_vocabulary, known_terms, raw_weight, term_table, term_weights,
)
from pressmill.session import materialize


@dataclass(frozen=True)
class BayesModel:
    """``terms``: field, term, idf, theta_0, theta_1; ``priors``: log class shares."""

    fields: tuple[Field, ...]
    terms: DataFrame
    priors: tuple[float, float]

    def save(self, path: str) -> None:
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        self.terms.sparkSession.createDataFrame(
            [(0, self.priors[0]), (1, self.priors[1])], "label int, log_prior double"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/priors")

    @classmethod
    def load(cls, spark, path: str, fields: Sequence[Field]) -> BayesModel:
        priors = dict(spark.read.parquet(f"{path}/priors").collect())
        return cls(tuple(fields), spark.read.parquet(f"{path}/terms"), (priors[0], priors[1]))


def nb_fit(train: DataFrame, fields: Sequence[Field], alpha: float = NB_ALPHA,
           vocabulary: DataFrame | None = None, label: str = "label",
           id_column: str = "id") -> BayesModel:
    """Fit on documents labelled 0 or 1.

    Per class: ``ln((sum w + alpha) / (sum over terms + alpha * |V|))`` and the
    unsmoothed log share of the class. Only six totals reach the driver. Documents that
    are scored too are best counted once for both, by ``count_terms``.
    """
    if vocabulary is None:
        train = count_terms(train, fields, (id_column, label))
    n0, n1 = train.agg(*[F.count_if(F.col(label) == c) for c in (0, 1)]).first()
    if vocabulary is None:
        vocabulary = fit_vocabulary(train, fields, n0 + n1, id_column)
    weights = term_weights(train, vocabulary, fields, (id_column, label), id_column)
    seen = weights.groupBy("field", "term").agg(
        *[F.sum(F.when(F.col(label) == c, F.col("weight"))).alias(f"s{c}") for c in (0, 1)]
    )
    # A term of a given vocabulary counts also if no training row has it.
    sums = materialize(
        vocabulary.select("field", "term", "idf").join(seen, ["field", "term"], "left").select(
            "field", "term", "idf",
            *[F.coalesce(f"s{c}", F.lit(0.0)).alias(f"s{c}") for c in (0, 1)],
        ),
        "nb-sums",
    )
    total = sums.agg(F.sum("s0").alias("s0"), F.sum("s1").alias("s1"),
                     F.count(F.lit(1)).alias("v")).first()
    thetas = [
        F.log((F.col(f"s{c}") + alpha) / F.lit((total[f"s{c}"] or 0.0) + alpha * total["v"]))
        .alias(f"theta_{c}")
        for c in (0, 1)
    ]
    terms = sums.select("field", "term", "idf", *thetas)
    return BayesModel(tuple(fields), terms, (_log(n0, n0 + n1), _log(n1, n0 + n1)))


def _log(part: int, whole: int) -> float:
    return log(part / whole) if part else float("-inf")


def nb_predict(df: DataFrame, model: BayesModel, keep: Sequence[str] = ("id",)) -> DataFrame:
    """``keep..., score, prediction``; ``keep`` must begin with a unique id.

    The score is the log-odds of class 1, and ties go to class 0. Dividing the
    summed products by the norm equals summing unit-length products, so a
    document needs no second pass, and its terms combine on the map side. A
    document without known terms gets the prior.
    """
    counts = term_table(df, model.fields, keep, outer=True)
    odds = model.terms.select(
        "field", "term", "idf", (F.col("theta_1") - F.col("theta_0")).alias("odds")
    )
    scored = known_terms(counts, odds, outer=True).select(
        *keep, "field", raw_weight(model.fields).alias("w"), "odds"
    )
    per_field = scored.groupBy(*keep, "field").agg(
        F.sum(F.col("w") * F.col("odds")).alias("dot"),
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
    ).withColumn("part", F.coalesce(F.try_divide("dot", "norm"), F.lit(0.0)))
    if len(model.fields) > 1:
        per_field = per_field.groupBy(*keep).agg(F.sum("part").alias("part"))
    bias = model.priors[1] - model.priors[0]
    return per_field.select(
        *keep, (F.col("part") + F.lit(bias)).alias("score")
    ).withColumn("prediction", (F.col("score") > 0).cast("int"))

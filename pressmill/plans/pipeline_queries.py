"""Whole runs: cleaning, metadata, deduplication, split by class, label, naive Bayes, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.functions import labels, text
from pressmill.operators import bayes, cleaning, evaluation, features, metadata
from pressmill.operators.dedup import deduplicate_text
from pressmill.operators.sampling import fixed_size_sample
from pressmill.operators.splitting import stratified_split
from pressmill.plans import views as V
from pressmill.plans.model_queries import (
    NB_FIELD, metric_sql, nb_sql, tf_sql, train_rows, vocab_sql, weight_sql,
)
from pressmill.plans.registry import query, rounded
from pressmill.plans.split_queries import META_ROWS
from pressmill.plans.stem_queries import CLEANED
from pressmill.session import materialize

_UNIQUE = """uniq AS (SELECT id, type, processed_text FROM (SELECT *, row_number() OVER
    (PARTITION BY md5(processed_text) ORDER BY id) AS r FROM clean WHERE type IS NOT NULL)
  WHERE r = 1)"""
_LABEL = V.strict_sql("type")


def _model_sql(f: features.Field, source: str) -> list[str]:
    return [*tf_sql([f], source), *vocab_sql([f], source), *weight_sql([f]), *nb_sql(source)]


def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = materialize(cleaning.processed_articles(V.articles(spark, sf_dir)), "processed")
    return deduplicate_text(processed.where(F.col("type").isNotNull()))


def _labelled(rows: DataFrame) -> DataFrame:
    split = stratified_split(materialize(rows, "unique"), "type")
    labelled = split.withColumn("label", labels.map_label_strict("type"))
    return materialize(labelled.where(F.col("label").isNotNull()), "labelled")


def _metrics(rows: DataFrame, f: features.Field) -> DataFrame:
    model = bayes.nb_fit(train_rows(rows), [f])
    return rounded(evaluation.metrics_by_split(bayes.nb_predict(rows, model, ["id", "split", "label"])))


@query("pipeline_nb", V.with_sql(
    *CLEANED, _UNIQUE, V.labelled_sql(_LABEL, "uniq", "type"),
    *_model_sql(features.NB_TEXT, "labelled")) + metric_sql("scored"))
def pipeline_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes on the stemmed text, from raw articles to metrics per split."""
    return _metrics(_labelled(_unique(spark, sf_dir)), features.NB_TEXT)


@query("pipeline_nb_meta", V.with_sql(
    *CLEANED, _UNIQUE, V.RAW_METADATA, META_ROWS,
    "with_meta AS (SELECT u.*, m.domain, m.title, m.authors FROM uniq u LEFT JOIN meta m USING (id))",
    V.labelled_sql(_LABEL, "with_meta", "type"),
    """combined AS (SELECT id, split, label, coalesce(domain, '') || ' ' || coalesce(title, '')
      || ' ' || coalesce(authors, '') || ' ' || processed_text AS combined_text FROM labelled)""",
    *_model_sql(features.NB_COMBINED, "combined")) + metric_sql("scored"))
def pipeline_nb_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the metadata in front of the text."""
    merged = metadata.merge_metadata(
        _unique(spark, sf_dir), V.raw_metadata(spark, sf_dir), order=["seq"])
    rows = _labelled(merged).withColumn("combined_text", text.combine_text_and_meta("processed_text"))
    return _metrics(rows.select("id", "split", "label", "combined_text"), features.NB_COMBINED)


_SAMPLE = f"""picked AS (SELECT * FROM labelled WHERE split = 'train'
    ORDER BY md5('42:' || id), id LIMIT {C.VOCABULARY_SAMPLE_ROWS})"""


@query("nb_fixed_vocabulary", V.with_sql(
    V.ARTICLES, V.LABELLED, _SAMPLE, *tf_sql([NB_FIELD], "picked", "s_"),
    *vocab_sql([NB_FIELD], "picked", "s_"), "vocab AS (SELECT * FROM s_vocab)",
    *tf_sql([NB_FIELD], "labelled"), *weight_sql([NB_FIELD]), *nb_sql("labelled"))
    + "SELECT term, round(theta_0, 6) AS theta_0, round(theta_1, 6) AS theta_1 FROM theta")
def nb_fixed_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All training rows under the vocabulary of a sample of fixed size."""
    train = train_rows(V.labelled(spark, sf_dir))
    sample = materialize(fixed_size_sample(train), "picked")
    vocabulary = features.fit_vocabulary(sample, [NB_FIELD])
    model = bayes.nb_fit(train, [NB_FIELD], vocabulary=vocabulary)
    return rounded(model.terms.select("term", "theta_0", "theta_1"))

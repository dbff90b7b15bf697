"""The plans the operators are written for: few shuffles, early filters."""

import re

import pytest
from pyspark.sql import functions as F

from pressmill.operators import bayes, cleaning, dedup, features, metadata, splitting
from pressmill.operators.features import Field
from pressmill.session import materialize


def plan(df):
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "simple")
    return text


def shuffles(df):
    return len(re.findall(r"[^a-zA-Z]Exchange ", plan(df)))


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return materialize(documents.select(
        F.col("doc_id").alias("id"), F.col("source").alias("type"), "lang",
        (F.col("doc_id") % 2).cast("int").alias("label"), F.col("text").alias("content"),
    ), "plan-rows")


FIELD = Field("text", "content", max_features=500, sublinear=True)


def test_split_is_assigned_in_a_map(rows):
    split = splitting.stratified_split(rows)
    assert shuffles(split) == 0 and "BroadcastHashJoin" in plan(split)


def test_split_passes_read_two_columns(rows):
    split = splitting.stratified_split(rows).select("id", "split")
    scans = re.findall(r"ReadSchema: (\S+)", plan(split))
    assert not any("content" in schema for schema in scans)


def test_keep_first_combines_before_its_one_shuffle(rows):
    unique = dedup.deduplicate_text(rows, "content")
    assert shuffles(unique) == 1 and "partial_min" in plan(unique)
    assert "Window" not in plan(unique)


def test_scoring_moves_one_row_per_document(rows):
    model = bayes.nb_fit(rows, [FIELD])
    scored = plan(bayes.nb_predict(rows, model, ["id"]))
    assert len(re.findall(r"[^a-zA-Z]Exchange ", scored)) == 1
    # The partial sums lie below the exchange.
    assert scored.index("Exchange hashpartitioning") < scored.index("partial_sum")


def test_weights_move_documents_not_terms(rows):
    vocabulary = features.fit_vocabulary(rows, [FIELD])
    text = plan(features.term_weights(rows, vocabulary, [FIELD]))
    assert len(re.findall(r"[^a-zA-Z]Exchange ", text)) == 1
    # Reading downwards: the terms are made above the exchange of the documents.
    assert text.index("Generate inline") < text.index("REPARTITION_BY_COL")


def test_term_counts_need_no_shuffle(rows):
    assert shuffles(features.term_table(rows, [FIELD])) == 0


def test_filters_and_columns_reach_the_scan(rows):
    usable = plan(splitting.drop_unusable(rows, "type", "content").select("id"))
    assert "IsNotNull(type)" in usable and "IsNotNull(content)" in usable
    kept = plan(metadata.extract_metadata(rows, ["lang"]))
    assert "content" not in re.search(r"ReadSchema: (\S+)", kept).group(1)


def test_tokens_are_computed_once(rows):
    text = plan(cleaning.processed_articles(rows))
    assert text.count("regexp_extract_all") == 1 and text.count("ArrowEvalPython") == 1


def test_no_broadcast_hints():
    import pathlib

    import pressmill

    for path in pathlib.Path(pressmill.__file__).parent.rglob("*.py"):
        source = path.read_text()
        assert "F.broadcast(" not in source and ".crossJoin(" not in source
        assert "localCheckpoint" not in source


def test_words_are_made_once(rows):
    from pressmill.functions import text

    counts = cleaning.word_counts(rows.select(text.tokenize_alpha("content").alias("tokens")))
    assert plan(counts).count("regexp_extract_all") == 1


def test_sample_rows_take_the_rows_first(rows):
    from pressmill.operators import profile

    sampled = plan(profile.sample_rows(rows))
    assert "rangepartitioning" not in sampled and "first-articles" in sampled


def test_only_passing_texts_are_stemmed(rows):
    report = plan(cleaning.quality_report(rows))
    stem = report[report.index("ArrowEvalPython"):]
    assert report.count("ArrowEvalPython") == 1 and "CASE WHEN (NOT boilerplate" in stem


def test_given_vocabulary_is_kept(spark):
    train = spark.createDataFrame([(1, 0, "aa bb"), (2, 1, "bb cc")], "id int, label int, content string")
    words = spark.createDataFrame(
        [("text", w, 1, 1, 1.5) for w in ("aa", "bb", "cc", "dd", "ee")],
        "field string, term string, df bigint, tf bigint, idf double")
    field = Field("text", "content")
    assert bayes.nb_fit(train, [field], vocabulary=words).terms.count() == 5

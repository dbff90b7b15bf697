"""Readers, writers, profile, evaluation and the incremental intake."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from pressmill import schemas
from pressmill.operators import cleaning, evaluation, profile, splitting
from pressmill.sinks import tables as sinks
from pressmill.sources import tables as sources
from pressmill.streaming.incremental import article_stream, incremental_clean


def test_csv_edge_cases(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(
        b'id,type,content\n1,fake,"two\nlines, ""quoted"""\n2,fake,a,surplus\n3,fake\n'
        b'4,reliable,caf\xff\xc3\xa9\n5,a,b,\n')
    got = {r["id"]: (r["type"], r["content"])
           for r in sources.read_articles_csv(spark, str(path)).collect()}
    assert got == {
        "1": ("fake", 'two\nlines, "quoted"'),
        "3": ("fake", None),
        "4": ("reliable", "café"),
    }
    flat = tmp_path / "flat.csv"
    flat.write_text("id,type,content\n1,a,b\n2,a,b,c\n3,a\n")
    lines = sources.read_articles_csv(spark, str(flat), multiline=False)
    assert sorted(r["id"] for r in lines.collect()) == ["1", "3"]
    some = sources.read_articles_csv(spark, str(path), ["content", "id"])
    assert some.columns == ["content", "id"] and some.count() == 3


def test_claims_tsv(spark, tmp_path):
    path = tmp_path / "c.tsv"
    row = ["7.json", "half-true", 'Says "x" is\ty', "health", "ann", "", "", "none",
           "1", "2", "3", "4", "5", "a speech"]
    row[2] = '"Says ""x"" is fine"'
    path.write_text("\t".join(row) + "\n" + "\t".join(row[:3]) + "\n")
    first, short = sources.read_claims_tsv(spark, str(path)).collect()
    assert first["statement"] == 'Says "x" is fine' and first["pants_on_fire_counts"] == 5
    assert first["context"] == "a speech" and short["speaker"] is None


def test_detect_columns(spark):
    table = spark.createDataFrame([(1, "a", "t", "x", "y")],
                                  "id int, type string, title string, text string, other string")
    assert sources.detect_columns(table).columns == ["id", "type", "text", "title"]
    with pytest.raises(ValueError, match="type"):
        sources.resolve_text_column(["id", "content"])
    with pytest.raises(ValueError, match="text column"):
        sources.resolve_text_column(["id", "type"])


ARTICLES = [
    (str(i), "fake" if i % 2 else "reliable",
     " ".join(f"stories{'abcdefghijklmnopqrstuvwxyz'[j % 26]} running" if j % 9 == 0
              else f"word{'abcdefghijklmnopqrstuvwxyz'[(i + j) % 26]}x{'abcdefgh'[j % 8]}"
              for j in range(60)), None, "t", None, None)
    for i in range(40)
] + [("50", "fake", "too short", None, None, None, None),
     ("51", "fake", None, None, None, None, None),
     ("52", None, " \n ", None, None, None, None),
     ("53", "fake", "123 456", None, None, None, None),
     ("54", "fake", "the the the", None, None, None, None)]


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(ARTICLES, schemas.ARTICLE)


def test_accounting(articles):
    row = profile.row_accounting(articles).first()
    # "123 456" is neither analysed nor missing.
    assert (row["rows_seen"], row["rows_analyzed"], row["rows_missing_content"]) == (45, 42, 2)


def test_cleaning_reports_reasons(articles):
    reasons = {r["id"]: r["drop_reason"] for r in cleaning.quality_report(articles).collect()}
    assert reasons["50"] == "tokens" and "51" not in reasons and "54" not in reasons
    kept = {r["id"] for r in cleaning.processed_articles(articles).collect()}
    assert kept == {i for i, reason in reasons.items() if reason is None}


def test_stemmed_boilerplate(spark):
    filler = " ".join(f"{a}{b}word" for a in "bcdfgh" for b in "bcdfgh")
    rows = spark.createDataFrame([("1", "fake", "Water coolers opened threads " + filler),
                                  ("2", "fake", "View galleries " + filler),
                                  ("3", "fake", filler)], "id string, type string, content string")
    reasons = {r["id"]: r["drop_reason"] for r in cleaning.quality_report(rows).collect()}
    assert reasons["2"] == "boilerplate" and reasons["3"] is None
    assert reasons["1"] == "stemmed_boilerplate"


def test_cleaning_has_no_shuffle_and_one_python_pass(articles):
    plan = articles.sparkSession._jvm.PythonSQLUtils.explainString(
        cleaning.processed_articles(articles)._jdf.queryExecution(), "formatted")
    tree = plan.split("\n\n\n")[0]
    assert "Exchange" not in tree and tree.count("ArrowEvalPython") == 1


def test_incremental_equals_batch(spark, articles, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    half = F.col("id").cast("int") % 2 == 0
    articles.where(half).coalesce(1).write.parquet(source)
    stream = lambda: incremental_clean(
        article_stream(spark, source), out, str(tmp_path / "ckpt"))
    stream().awaitTermination()
    articles.where(~half).coalesce(1).write.mode("append").parquet(source)
    stream().awaitTermination()
    stream().awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert got == sorted(map(tuple, cleaning.processed_articles(articles).collect()))


def test_splits_round_trip(spark, articles, tmp_path):
    processed = cleaning.processed_articles(articles)
    split = splitting.stratified_split(processed)
    sinks.write_splits(split, str(tmp_path / "s"))
    for name in splitting.SPLITS:
        back = sources.read_split(spark, str(tmp_path / "s"), name)
        assert sorted(r["id"] for r in back.collect()) == sorted(
            r["id"] for r in split.where(F.col("split") == name).collect())


def test_processed_csv_round_trip(spark, articles, tmp_path):
    processed = cleaning.processed_articles(articles)
    out = str(tmp_path / "p.csv")
    sinks.write_processed(processed, out, str(tmp_path / "preview"), 5, fmt="csv")
    back = sources.read_articles_csv(spark, out, header=["id", "type", "processed_text"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, processed.collect()))
    assert spark.read.option("header", True).csv(str(tmp_path / "preview")).count() == 5
    sinks.append_processed(processed, out, fmt="csv")
    again = sources.read_articles_csv(spark, out, header=["id", "type", "processed_text"])
    assert again.count() == 2 * processed.count()


def test_profile_tables(spark, articles, tmp_path):
    names = sinks.write_profile(articles, str(tmp_path / "profile"))
    assert len(names) == 24
    rows = json.loads(open(glob.glob(str(tmp_path / "profile/rows/*.json"))[0]).readline())
    assert rows["rows_seen"] == 45
    words = spark.read.option("header", True).csv(str(tmp_path / "profile/top_words_stemmed"))
    assert words.where("word = 'run'").count() == 1


def test_histogram_of_equal_lengths(spark):
    rows = spark.createDataFrame([("a", 7, 3), ("b", 7, 2)], "label string, token_count int, n int")
    got = [(r["bin"], r["count"], r["lower_edge"]) for r in profile.length_histogram(rows).collect()]
    assert got == [(0, 5, 7.0)]


def test_findings_need_a_difference(spark):
    even = spark.createDataFrame([("a", 10), ("b", 10)], "label string, count int")
    assert profile.imbalance_finding(even).count() == 0
    means = spark.createDataFrame([("a", 1.0, 5.0), ("b", 1.0, 9.0)],
                                  "label string, url_mean double, token_mean double")
    got = profile.class_contrast(means).collect()
    assert [(r["feature"], r["highest"], r["lowest"]) for r in got] == [("token", "b", "a")]


def test_metrics_without_positive_guesses(spark):
    rows = spark.createDataFrame([("s", 1, 0), ("s", 0, 0)],
                                 "split string, label int, prediction int")
    row = evaluation.metrics_by_split(rows, pos_label=1).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)
    report = {r["class"]: r for r in evaluation.classification_report(rows).collect()}
    assert report["1"]["f1"] == 0.0 and report["accuracy"]["support"] == 2


def test_confusion_sums_to_rows(spark):
    rows = spark.range(500).select((F.col("id") % 2).alias("label"),
                                   (F.col("id") % 3 % 2).alias("prediction"))
    assert sum(evaluation.confusion_matrix(rows).first()) == 500


def test_best_candidate_first_wins(spark):
    rows = spark.createDataFrame([(0.01, .5), (0.1, .7), (1.0, .7)], "c double, f1 double")
    assert tuple(evaluation.best_candidate(rows, "c").first()) == (0.1, .7)


def test_evaluation_files(spark, tmp_path):
    rows = spark.createDataFrame([("val", 1, 1), ("test", 0, 1)],
                                 "split string, label int, prediction int")
    sinks.write_evaluation(rows, str(tmp_path / "e"), alpha=0.1)
    summary = spark.read.json(str(tmp_path / "e/summary"))
    assert summary.count() == 2 and summary.first()["alpha"] == "0.1"
    assert spark.read.option("header", True).csv(str(tmp_path / "e/confusion_matrix")).count() == 2


def test_files_with_another_column_order_fail(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("id,type,content\n1,fake,one\n")
    (folder / "b.csv").write_text("id,type,content\n2,hate,two\n")
    rows = sources.read_articles_csv(spark, str(folder))
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "fake", "one"), ("2", "hate", "two")]
    (folder / "c.csv").write_text("type,id,content\nfake,3,three\n")
    with pytest.raises(Exception, match="another order"):
        sources.read_articles_csv(spark, str(folder), header=["id", "type", "content"]).collect()


def test_csv_stream_keeps_what_the_batch_reader_keeps(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    header = ",".join(schemas.ARTICLE.fieldNames())
    (folder / "a.csv").write_bytes(
        header.encode() + b'\n1,fake,"a ""b""\nc",,,,\n2,fake,x,,,,,surplus\n3,fake\n4,fake,\xffy,,,,\n')
    batch = sources.read_articles_csv(spark, str(folder)).select("id", "content")
    stream = article_stream(spark, str(folder), fmt="csv").select("id", "content")
    out = str(tmp_path / "out")
    stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start().awaitTermination()
    found = sorted(map(tuple, spark.read.parquet(out).collect()), key=str)
    assert found == sorted(map(tuple, batch.collect()), key=str)
    assert [r[0] for r in found] == ["1", "3", "4"]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from pressmill import session

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf()

    for conf in ({}, {"spark.master": "spark://x"}, {"spark.master": "yarn", "spark.checkpoint.dir": "file:/tmp/x"}):
        Session.conf = Conf(conf)
        with pytest.raises(RuntimeError):
            session.shared_root(Session)
    Session.conf = Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:/x"})
    assert session.shared_root(Session) == "hdfs:/x"

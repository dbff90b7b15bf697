"""Round trips through the readers, the writers and the stream.

Each query writes what a view holds below the shared folder and reads it back, so its
SQL is the view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.operators import bayes, profile, sketches
from pressmill.operators.features import count_terms
from pressmill.plans import profile_queries, stem_queries  # noqa: F401  (their SQL is used here)
from pressmill.plans import views as V
from pressmill.plans.model_queries import KEEP, NB_FIELD, metric_sql, train_rows
from pressmill.plans.registry import ORACLE, query, rounded
from pressmill.session import materialize, stage_path, with_settings
from pressmill.sinks import tables as sinks
from pressmill.sources import tables as sources
from pressmill.streaming.incremental import article_stream, incremental_clean
from pressmill.streaming.totals import RunningTotals, add_articles, incremental_totals

_A = V.with_sql(V.ARTICLES)


@query("csv_round_trip", f"""{_A} SELECT CAST(id AS VARCHAR) AS id, type,
  CASE WHEN id % 3 = 0 THEN md5(content) END AS content_md5 FROM articles WHERE id % 3 <> 1""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted fields with line breaks stay whole; surplus rows go, short ones are padded."""
    quoted = F.concat(F.lit('"'), F.regexp_replace("content", '"', '""'), F.lit('"'))
    kind = F.coalesce(F.concat(F.lit('"'), F.col("type"), F.lit('"')), F.lit(""))
    key = F.col("id").cast("string")
    line = F.when(F.col("id") % 3 == 0, F.concat_ws(",", key, kind, quoted)) \
        .when(F.col("id") % 3 == 1, F.concat_ws(",", key, kind, quoted, F.lit("surplus"))) \
        .otherwise(F.concat_ws(",", key, kind))
    path = stage_path(spark, "csv")
    V.articles(spark, sf_dir).select(line.alias("value")).write.text(path)
    read = sources.read_articles_csv(spark, path, header=["id", "type", "content"])
    return read.select("id", "type", F.md5("content").alias("content_md5"))


@query("csv_one_file", f"""{_A} SELECT CAST(id AS VARCHAR) AS id, type,
  CASE WHEN id % 3 = 0 THEN md5(content) END AS content_md5, true AS parallel FROM articles WHERE id % 3 <> 1""")
def csv_one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file whose fields span lines, read by many tasks; a surplus field may be empty."""
    quoted = F.concat(F.lit('"'), F.regexp_replace("content", '"', '""'), F.lit('"'))
    kind = F.coalesce(F.concat(F.lit('"'), F.col("type"), F.lit('"')), F.lit(""))
    key = F.col("id").cast("string")
    line = F.when(F.col("id") % 3 == 0, F.concat_ws(",", key, kind, quoted)) \
        .when(F.col("id") % 3 == 1, F.concat_ws(",", key, kind, quoted, F.lit(""))) \
        .otherwise(F.concat_ws(",", key, kind))
    path = stage_path(spark, "csv")
    V.articles(spark, sf_dir).select(line.alias("value")).repartition(1).write.text(path)
    with with_settings(spark, {"spark.sql.files.maxPartitionBytes": "256k", "spark.sql.files.openCostInBytes": "0"}):
        read = sources.read_articles_csv(spark, path, header=["id", "type", "content"])
        read = materialize(read.withColumn("task", F.spark_partition_id()), "articles")
    several = read.agg(F.count_distinct("task").alias("tasks")).first()["tasks"] > 1
    return read.select("id", "type", F.md5("content").alias("content_md5"), F.lit(several).alias("parallel"))


@query("tsv_round_trip", V.with_sql(V.CLAIMS) + """SELECT CAST(id AS VARCHAR) AS id, label,
  md5(statement) AS statement_md5, subject, speaker, id % 5 AS false_counts FROM claims""")
def tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements as a header-less file of fourteen columns."""
    source = V.claims(spark, sf_dir).withColumn("false_counts", (F.col("id") % 5).cast("int"))
    columns = [F.col(c) if c in source.columns else F.lit(None).cast("string").alias(c)
               for c in C.CLAIM_COLUMNS]
    path = stage_path(spark, "tsv")
    source.select(columns).write.options(
        sep="\t", header=False, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False).csv(path)
    read = sources.read_claims_tsv(spark, path)
    return rounded(read.select("id", "label", F.md5("statement").alias("statement_md5"),
                               "subject", "speaker", "false_counts"))


_PROCESSED = "CAST(id AS VARCHAR) AS id, type, md5(content) AS text_md5"


def _as_processed(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").cast("string").alias("id"), "type",
                     F.col("content").alias("processed_text"))


@query("processed_round_trip", f"{_A} SELECT {_PROCESSED}, 10 AS preview_rows FROM articles")
def processed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, appended to, and read; the preview has the rows it was asked for."""
    rows = _as_processed(V.articles(spark, sf_dir))
    path = stage_path(spark, "processed")
    sinks.write_processed(rows.where("id % 2 = 0"), path, f"{path}-preview", 10)
    sinks.append_processed(rows.where("id % 2 = 1"), path)
    preview = spark.read.parquet(f"{path}-preview").count()
    read = sources.read_split(spark, path)
    return read.select("id", "type", F.md5("processed_text").alias("text_md5"),
                       F.lit(preview).cast("bigint").alias("preview_rows"))


@query("splits_round_trip", V.with_sql(V.ARTICLES, V.LABELLED)
       + f"SELECT {_PROCESSED} FROM labelled WHERE split = 'val'")
def splits_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One directory per split; reading one of them leaves the others alone."""
    rows = V.labelled(spark, sf_dir, columns=("type", "content"))
    path = stage_path(spark, "splits")
    sinks.write_splits(rows.select("split", F.col("id").cast("string").alias("id"), "type",
                                   F.col("content").alias("processed_text")), path)
    read = sources.read_split(spark, path, "val")
    return read.select("id", "type", F.md5("processed_text").alias("text_md5"))


@query("profile_round_trip", ORACLE["class_distribution"])
def profile_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class table of a written profile."""
    path = stage_path(spark, "profile")
    sinks.write_profile(V.articles(spark, sf_dir), path)
    distribution = profile.class_distribution(profile.analyzed(V.articles(spark, sf_dir)))
    read = spark.read.schema(distribution.schema).option("header", True).csv(f"{path}/class_distribution")
    return rounded(read)


@query("evaluation_round_trip", V.with_sql(V.PREDICTIONS) + metric_sql("predictions"))
def evaluation_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "evaluation")
    sinks.write_evaluation(V.predictions(spark, sf_dir), path, alpha=C.NB_ALPHA)
    schema = "split string, accuracy double, precision double, recall double, f1 double"
    return rounded(spark.read.schema(schema).option("header", True).csv(f"{path}/metrics"))


@query("model_round_trip", ORACLE["nb_predict"])
def model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a model that was saved and loaded."""
    rows = count_terms(V.labelled(spark, sf_dir), [NB_FIELD], KEEP)
    path = stage_path(spark, "model")
    bayes.nb_fit(train_rows(rows), [NB_FIELD]).save(path)
    model = bayes.BayesModel.load(spark, path, [NB_FIELD])
    return rounded(bayes.nb_predict(rows, model, ["id", "split", "label"]))


@query("incremental_clean", ORACLE["processed_articles"])
def incremental_clean_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive before and after a first run end up in one table, each once."""
    articles = V.articles(spark, sf_dir).select("id", "type", "content")
    root = stage_path(spark, "incoming")
    for arrived in ("id % 3 = 0", "id % 3 <> 0"):
        articles.where(arrived).write.mode("append").parquet(f"{root}/in")
        stream = article_stream(spark, f"{root}/in", articles.schema)
        incremental_clean(stream, f"{root}/out", f"{root}/mark").awaitTermination()
    return spark.read.parquet(f"{root}/out")


_FEATURE_SQL = " UNION ALL ".join(
    f"""SELECT {level} AS label, '{f}' AS feature, count(*) AS n, avg({f}_count) AS mean,
      stddev_pop({f}_count) AS std, min({f}_count) AS least, max({f}_count) AS most FROM features {group}"""
    for f in profile.FEATURES for level, group in (("NULL", ""), ("type", "GROUP BY type")))
_LONG = (("n", "n"), ("mean", "mean"), ("std", "std"), ("min", "least"), ("max", "most"))
_TOTALS_SQL = V.with_sql(
    *stem_queries.CLEANED, *stem_queries._CLEAN_WORDS, V.FEATURES, f"per_class AS ({_FEATURE_SQL})",
    f"verdict AS ({stem_queries.DROP_REASONS})") + f"""
  SELECT 'rows' AS part, CASE WHEN a.content IS NULL THEN 'null_text' WHEN v.id IS NULL THEN 'no_words'
    ELSE coalesce(v.drop_reason, 'kept') END AS label, NULL AS feature, CAST(count(*) AS DOUBLE) AS value
  FROM articles a LEFT JOIN verdict v ON v.id = a.id GROUP BY ALL
  UNION ALL SELECT 'vocabulary', name, NULL, CAST(value AS DOUBLE) FROM (UNPIVOT sizes ON COLUMNS(*) INTO NAME name VALUE value)
  UNION ALL SELECT 'texts', 'n_rows', NULL, count(*) FROM features
  UNION ALL SELECT 'texts', 'unique_contents', NULL, count(DISTINCT content) FROM features
  """ + " ".join(f"UNION ALL SELECT '{name}', label, feature, round({c}, 6) FROM per_class" for name, c in _LONG)


def _long(df: DataFrame, part: str) -> DataFrame:
    """Columns of a one-row table as rows."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in df.columns])
    return wide.unpivot([], wide.columns, "label", "value").select(
        F.lit(part).alias("part"), "label", F.lit(None).cast("string").alias("feature"), "value")


@query("running_totals", _TOTALS_SQL)
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over two increments, one of them replayed, with the parts merged in between."""
    articles = V.articles(spark, sf_dir)
    root = stage_path(spark, "totals")
    state = RunningTotals(spark, f"{root}/state")
    for arrived in ("id % 3 = 0", "id % 3 <> 0"):
        articles.where(arrived).write.mode("append").parquet(f"{root}/in")
        stream = article_stream(spark, f"{root}/in", articles.schema)
        incremental_totals(stream, f"{root}/out", state.path, f"{root}/mark").awaitTermination()
        if arrived == "id % 3 = 0":
            add_articles(articles.where(arrived), state, f"{root}/out", 0)
            state.compact()
    for batch, arrived in enumerate(("id % 3 = 0", "id % 3 <> 0")):  # once merged already, once not yet
        add_articles(articles.where(arrived), state, f"{root}/out", batch)
    stats = state.feature_stats()
    parts = [_long(state.vocabulary_sizes(), "vocabulary"), _long(state.duplicates(), "texts"),
             state.row_totals().select(F.lit("rows").alias("part"), F.col("outcome").alias("label"),
                                       F.lit(None).cast("string").alias("feature"), F.col("n").cast("double").alias("value"))]
    for name, column in (("n", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("max", "max")):
        parts.append(stats.select(F.lit(name).alias("part"), "label", "feature", F.col(column).cast("double").alias("value")))
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return rounded(total)


@query("merged_sketches", f"""{V.with_sql(V.ARTICLES, V.FEATURES)} SELECT type AS label, true AS ranks_close, true AS counts_close
  FROM features GROUP BY type UNION ALL SELECT NULL, true, true FROM features HAVING count(*) > 0""")
def merged_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of three increments, stored and merged per class and over all, against exact figures.

    A quantile is close if its rank is within 1 %, or its own ties reach there; a count within 3 %.
    """
    rows = profile.analyzed(V.articles(spark, sf_dir)).select("id", "type", "token_count", "content")
    path = stage_path(spark, "sketches")
    for part in range(3):
        sketches.sketch(rows.where(f"id % 3 = {part}"), ["type"]).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    every = sketches.merged(stored, ["type"]).unionByName(
        sketches.merged(stored).withColumn("type", F.lit(None).cast("string")))
    every = materialize(every, "merged")
    both = rows.select("type", "token_count", "content").unionByName(
        rows.select(F.lit(None).cast("string").alias("type"), "token_count", "content"))
    points = sketches.quantiles(every, ["type"])
    lengths = both.groupBy("type", "token_count").agg(F.count(F.lit(1)).alias("c"))
    ranks = points.alias("p").join(lengths.alias("l"), F.col("p.type").eqNullSafe(F.col("l.type"))).groupBy(
        "p.type", "p.quantile", "p.value").agg(
        (F.sum(F.when(F.col("token_count") < F.col("value"), F.col("c")).otherwise(0)) / F.sum("c")).alias("low"),
        (F.sum(F.when(F.col("token_count") <= F.col("value"), F.col("c")).otherwise(0)) / F.sum("c")).alias("high"))
    close = ranks.groupBy("type").agg(F.bool_and(
        (F.col("low") - 0.01 <= F.col("quantile")) & (F.col("quantile") <= F.col("high") + 0.01)).alias("ranks_close"))
    exact = both.groupBy("type").agg(F.count_distinct("content").alias("exact"))
    counted = sketches.duplicate_stats(every, ["type"]).alias("s").join(
        exact.alias("e"), F.col("s.type").eqNullSafe(F.col("e.type"))).select(
        "s.type", (F.abs(F.col("unique_contents") - F.col("exact")) <= 0.03 * F.col("exact")).alias("counts_close"))
    return close.alias("a").join(counted.alias("b"), F.col("a.type").eqNullSafe(F.col("b.type"))).select(
        F.col("a.type").alias("label"), "ranks_close", "counts_close")

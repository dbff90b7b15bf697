"""Corpus profile tables over the articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.functions import labels, quality, text
from pressmill.operators import cleaning, profile
from pressmill.operators.dedup import duplicate_stats
from pressmill.plans import views as V
from pressmill.plans.registry import query, rounded
from pressmill.session import materialize

_A = V.with_sql(V.ARTICLES)
_F = V.with_sql(V.ARTICLES, V.FEATURES)
_TOKENS = V.tokens_sql("content")
_KEPT = V.kept_sql(_TOKENS)


def _features(spark: SparkSession, sf_dir: str, tokens: bool = False) -> DataFrame:
    return profile.analyzed(V.articles(spark, sf_dir), tokens=tokens)


def _stats_sql(features=("token", "url", "date", "number")) -> str:
    return ", ".join(
        f"round(avg({f}_count), 6) AS {f}_mean, round(stddev_pop({f}_count), 6) AS {f}_std, "
        f"min({f}_count) AS {f}_min, max({f}_count) AS {f}_max" for f in features
    )


@query("class_profile", f"""{_A}, kept AS (
    SELECT type, {V.strict_sql('type')} AS label, len({_KEPT}) AS n FROM articles
    WHERE type NOT IN {V.in_sql(C.AMBIGUOUS_TYPES)}),
  usable AS (SELECT * FROM kept WHERE n > 0 AND label IS NOT NULL)
  SELECT type, label, count(*) AS n_rows,
    round(count(*) / CAST((SELECT count(*) FROM usable) AS DOUBLE), 6) AS share,
    round(avg(n), 6) AS token_mean, round(stddev_pop(n), 6) AS token_std,
    min(n) AS token_min, max(n) AS token_max FROM usable GROUP BY type, label""")
def class_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: tokenise, filter, label, and describe each usable class."""
    from pyspark.sql.window import Window

    source = V.articles(spark, sf_dir).where(~labels.is_ambiguous("type"))
    labelled = source.withColumn("label", labels.map_label_strict("type")) \
        .where(F.col("label").isNotNull())
    tokens = cleaning.with_tokens(labelled).select("type", "label", F.size("kept").alias("n"))
    stats = tokens.groupBy("type", "label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("n").alias("token_mean"),
        F.stddev_pop("n").alias("token_std"), F.min("n").alias("token_min"),
        F.max("n").alias("token_max"),
    )
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(0)))
    return rounded(stats.withColumn("share", F.col("n_rows") / total))


@query("row_accounting", f"""{_A} SELECT count(*) AS rows_seen,
    count(*) FILTER (len({_TOKENS}) > 0) AS rows_analyzed,
    count(*) FILTER (coalesce({V.clean_sql('content')}, '') = '') AS rows_missing_content
  FROM articles""")
def row_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_accounting(V.articles(spark, sf_dir))


_COLUMNS = ("id", "type", "content", "domain", "title", "authors", "url")


@query("missing_values", f"{_A} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing_count FROM articles"""
    for c in _COLUMNS))
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_values(V.articles(spark, sf_dir))


@query("class_distribution", f"""{_F} SELECT type AS label, count(*) AS "count",
  round(count(*) / CAST((SELECT count(*) FROM features) AS DOUBLE), 6) AS share
  FROM features GROUP BY type""")
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.class_distribution(_features(spark, sf_dir)))


@query("binary_balance", f"""{_A}, l AS (SELECT {V.strict_sql('type')} AS label FROM articles)
  SELECT CAST(label AS BIGINT) AS label, count(*) AS "count",
    round(100.0 * count(*) / CAST((SELECT count(label) FROM l) AS DOUBLE), 6) AS percent
  FROM l WHERE label IS NOT NULL GROUP BY label""")
def binary_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = V.articles(spark, sf_dir).select(labels.map_label_strict("type").alias("label"))
    return rounded(profile.binary_balance(mapped))


@query("feature_stats", f"""{_F} SELECT count(*) AS "count", {_stats_sql()} FROM features""")
def feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.feature_stats(_features(spark, sf_dir)))


@query("feature_stats_by_class", f"""{_F} SELECT type AS label, count(*) AS "count",
  {_stats_sql()} FROM features GROUP BY type""")
def feature_stats_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.feature_stats_by_class(_features(spark, sf_dir)))


@query("feature_stats_both", f"""{_F} SELECT type AS label, grouping(type) = 1 AS is_total,
  count(*) AS "count", {_stats_sql()} FROM features GROUP BY GROUPING SETS ((), (type))""")
def feature_stats_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.feature_stats_both(_features(spark, sf_dir)))


@query("feature_means_by_class", f"{_F} " + " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, type AS label, round(avg({f}_count), 6) AS mean
    FROM features GROUP BY type""" for f in profile.FEATURES))
def feature_means_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.feature_means_by_class(_features(spark, sf_dir)))


_Q = "[" + ", ".join(str(q) for q in C.LENGTH_QUANTILES) + "]"


@query("length_quantiles", f"""{_F} SELECT CAST(unnest({_Q}) AS DOUBLE) AS quantile,
  round(unnest(quantile_cont(token_count, {_Q})), 6) AS token_count FROM features""")
def length_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.length_quantiles(profile.length_counts(_features(spark, sf_dir))))


@query("length_quantiles_by_class", f"""{_F} SELECT type AS label,
  CAST(unnest({_Q}) AS DOUBLE) AS quantile,
  round(unnest(quantile_cont(token_count, {_Q})), 6) AS token_count
  FROM features GROUP BY type""")
def length_quantiles_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = profile.length_counts(_features(spark, sf_dir))
    return rounded(profile.length_quantiles_by_class(lengths))


_TEXTS = f"""texts AS (SELECT doc_id AS id, {V.clean_sql('text')} AS content FROM documents)"""
_DUPLICATES = """stats AS (SELECT count(*) AS n_rows, count(DISTINCT md5(content)) AS
    unique_contents FROM texts),
  duplicates AS (SELECT n_rows, unique_contents, n_rows - unique_contents AS duplicate_rows,
    round(100.0 * (n_rows - unique_contents) / CAST(n_rows AS DOUBLE), 6)
    AS duplicate_percent FROM stats)"""


def _document_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = V.table(spark, sf_dir, "documents").select(text.clean_text("text").alias("content"))
    return duplicate_stats(texts, "content")


@query("duplicate_stats", f"{V.with_sql(_TEXTS, _DUPLICATES)} SELECT * FROM duplicates")
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_document_duplicates(spark, sf_dir))


@query("duplicate_finding", f"""{V.with_sql(_TEXTS, _DUPLICATES)} SELECT * FROM duplicates
  WHERE duplicate_percent >= 1""")
def duplicate_finding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.duplicate_finding(_document_duplicates(spark, sf_dir)))


_WORDS = f"words AS (SELECT unnest({_TOKENS}) AS word FROM articles)"
_COUNTS = """counts AS (SELECT word, count(*) AS "count" FROM words GROUP BY word)"""
_COUNTED = V.with_sql(V.ARTICLES, _WORDS, _COUNTS)
_NOT_STOP = f"word NOT IN ({V.STOP_SQL})"


def _word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = V.articles(spark, sf_dir).select(text.tokenize_alpha("content").alias("tokens"))
    return cleaning.word_counts(tokens)


@query("word_freq_raw", f"{_COUNTED} SELECT * FROM counts")
def word_freq_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_counts(spark, sf_dir)


@query("word_freq_nostop", f"{_COUNTED} SELECT * FROM counts WHERE {_NOT_STOP}")
def word_freq_nostop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_stopword_rows(_word_counts(spark, sf_dir))


@query("top_words", f"""{_COUNTED}
  (SELECT 'raw' AS variant, * FROM counts ORDER BY "count" DESC, word LIMIT 100)
  UNION ALL
  (SELECT 'no_stop', * FROM counts WHERE {_NOT_STOP} ORDER BY "count" DESC, word LIMIT 100)""")
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = materialize(_word_counts(spark, sf_dir), "word-counts")
    raw = profile.top_words(counts).withColumn("variant", F.lit("raw"))
    kept = profile.top_words(cleaning.drop_stopword_rows(counts))
    return raw.unionByName(kept.withColumn("variant", F.lit("no_stop")))


@query("rank_frequency", f"""{_COUNTED} SELECT row_number() OVER (ORDER BY "count" DESC, word)
  AS rank, word, "count" AS frequency FROM counts ORDER BY rank LIMIT 10000""")
def rank_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.rank_frequency(_word_counts(spark, sf_dir))


@query("rank_frequency_nostop", f"""{_COUNTED} SELECT
  row_number() OVER (ORDER BY "count" DESC, word) AS rank, word, "count" AS frequency
  FROM counts WHERE {_NOT_STOP} ORDER BY rank LIMIT 10000""")
def rank_frequency_nostop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.rank_frequency(cleaning.drop_stopword_rows(_word_counts(spark, sf_dir)))


def _phrases_sql(x: str) -> str:
    return " OR ".join(f"contains({x}, '{p}')" for p in C.RAW_BOILERPLATE)


KEPT_ROWS = f"""tokenized AS (SELECT id, type, {_TOKENS} AS tokens, {_KEPT} AS kept FROM articles),
  per_word AS (SELECT id, w, count(*) AS c FROM
    (SELECT id, unnest(kept) AS w FROM tokenized) GROUP BY id, w),
  good AS (SELECT id FROM per_word GROUP BY id HAVING sum(c) BETWEEN 30 AND 1200
    AND count(*) / CAST(sum(c) AS DOUBLE) >= 0.28
    AND max(c) / CAST(sum(c) AS DOUBLE) <= 0.20),
  kept_rows AS (SELECT t.* FROM tokenized t JOIN good USING (id)
    WHERE NOT ({_phrases_sql("array_to_string(tokens, ' ')")}))"""


@query("vocab_sizes", f"""{V.with_sql(V.ARTICLES, KEPT_ROWS,
    'raw AS (SELECT unnest(tokens) AS word FROM kept_rows)')}
  SELECT count(DISTINCT word) AS vocab_raw, count(*) AS tokens_raw,
    count(DISTINCT word) FILTER ({_NOT_STOP}) AS vocab_no_stop,
    count(*) FILTER ({_NOT_STOP}) AS tokens_no_stop FROM raw""")
def vocab_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the rows the unstemmed quality tests keep."""
    tokens = cleaning.with_tokens(V.articles(spark, sf_dir).select("id", "content"))
    good = tokens.where(~quality.has_phrase(text.join_tokens("tokens"))) \
        .where(~quality.fails_token_quality("kept"))
    return cleaning.vocabulary_sizes(good, stems=False)


@query("vocab_union", f"""WITH w AS (
    SELECT unnest({V.tokens_sql('text')}) AS word FROM documents
    UNION SELECT unnest({V.tokens_sql('text')}) FROM conversations)
  SELECT DISTINCT word FROM w""")
def vocab_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary kept across two batches of texts."""
    parts = [
        cleaning.word_counts(V.table(spark, sf_dir, name).select(
            text.tokenize_alpha("text").alias("tokens")))
        for name in ("documents", "conversations")
    ]
    return cleaning.vocabulary_union(*parts)


_DISTRIBUTION = """d AS (SELECT type AS label, count(*) AS c FROM features GROUP BY type)"""


@query("imbalance_finding", f"""{V.with_sql(V.ARTICLES, V.FEATURES, _DISTRIBUTION)}
  SELECT (SELECT label FROM d ORDER BY c DESC, label LIMIT 1) AS largest,
    (SELECT label FROM d ORDER BY c, label DESC LIMIT 1) AS smallest,
    round(max(c) / CAST(min(c) AS DOUBLE), 6) AS ratio FROM d
  HAVING max(c) / CAST(min(c) AS DOUBLE) >= 1.2""")
def imbalance_finding(spark: SparkSession, sf_dir: str) -> DataFrame:
    distribution = profile.class_distribution(_features(spark, sf_dir))
    return rounded(profile.imbalance_finding(distribution))


def _contrast_sql(feature: str) -> str:
    return f"""SELECT '{feature}' AS feature,
    (SELECT label FROM m ORDER BY {feature} DESC, label LIMIT 1) AS highest,
    round((SELECT max({feature}) FROM m), 6) AS highest_mean,
    (SELECT label FROM m ORDER BY {feature}, label LIMIT 1) AS lowest,
    round((SELECT min({feature}) FROM m), 6) AS lowest_mean"""


@query("class_contrast", f"""{V.with_sql(V.ARTICLES, V.FEATURES,
    'm AS (SELECT type AS label, avg(url_count) AS url, avg(token_count) AS token '
    'FROM features GROUP BY type)')}
  SELECT * FROM ({_contrast_sql('url')} UNION ALL {_contrast_sql('token')})
  WHERE highest_mean > lowest_mean""")
def class_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_class = profile.feature_stats_by_class(_features(spark, sf_dir))
    return rounded(profile.class_contrast(by_class))


@query("length_histogram", f"""{_F}, bounds AS (SELECT min(token_count) AS lo,
    max(token_count) AS hi FROM features),
  binned AS (SELECT least(((token_count - lo) * 60) // (hi - lo), 59) AS bin
    FROM features, bounds)
  SELECT bin, count(*) AS "count",
    round(any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 60.0), 6) AS lower_edge
  FROM binned, bounds GROUP BY bin""")
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.length_histogram(profile.length_counts(_features(spark, sf_dir))))


def _top_sql(feature: str) -> str:
    return f"""{_F} SELECT id, type, title, domain, url, substr(content, 1, 250) AS preview,
  {feature}_count FROM features ORDER BY {feature}_count DESC, id LIMIT 30"""


def _register_top(name: str, feature: str) -> None:
    @query(name, _top_sql(feature))
    def top(spark: SparkSession, sf_dir: str) -> DataFrame:
        return profile.top_rows(_features(spark, sf_dir), feature)


for _name, _feature in (("top_url_rows", "url"), ("top_date_rows", "date"),
                        ("top_number_rows", "number"), ("longest_rows", "token")):
    _register_top(_name, _feature)


@query("sample_rows", f"""{_F} SELECT id, type, title, domain, url, content, token_count,
  url_count, date_count, number_count FROM features ORDER BY id LIMIT 1000""")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sample_rows(V.articles(spark, sf_dir))

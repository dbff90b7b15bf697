"""Text functions, filters and label mappings, one row per article."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.functions import labels, quality, text
from pressmill.operators import cleaning
from pressmill.plans import views as V
from pressmill.plans.registry import query, rounded

_A = V.with_sql(V.ARTICLES)
_TOKENS = V.tokens_sql("content")
_KEPT = V.kept_sql(_TOKENS)


@query("clean_text", f"{_A} SELECT id, {V.clean_sql('content')} AS cleaned FROM articles")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).select("id", text.clean_text("content").alias("cleaned"))


@query("tokenize_alpha", f"""{_A} SELECT id, array_to_string({_TOKENS}, ' ') AS tokens,
  len({_TOKENS}) AS token_count FROM articles""")
def tokenize_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = V.articles(spark, sf_dir).select(
        "id", text.tokenize_alpha("content").alias("t"))
    return tokens.select("id", text.join_tokens("t").alias("tokens"),
                         text.token_count("t").cast("bigint").alias("token_count"))


@query("phrase_norm", f"""{_A} SELECT id, trim(regexp_replace(regexp_replace(lower(content),
  '[^a-z\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS norm FROM articles""")
def phrase_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).select(
        "id", text.normalize_for_phrase_match("content").alias("norm"))


@query("stopword_filter", f"""{_A} SELECT id, array_to_string({_KEPT}, ' ') AS kept,
  len({_KEPT}) AS kept_count FROM articles""")
def stopword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = V.articles(spark, sf_dir).select(
        "id", text.remove_stopwords(text.tokenize_alpha("content")).alias("k"))
    return kept.select("id", text.join_tokens("k").alias("kept"),
                       F.size("k").cast("bigint").alias("kept_count"))


@query("url_counts", f"{_A} SELECT id, {V.URLS_SQL} AS url_count FROM articles")
def url_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).select("id", text.clean_text("content").alias("c")).select(
        "id", text.url_count("c").cast("bigint").alias("url_count"))


@query("date_counts", f"{_A} SELECT id, {V.DATES_SQL} AS date_count FROM articles")
def date_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).select("id", text.clean_text("content").alias("c")).select(
        "id", text.date_count("c").cast("bigint").alias("date_count"))


@query("number_counts", f"{_A} SELECT id, {V.NUMBERS_SQL} AS number_count FROM articles")
def number_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).select("id", text.clean_text("content").alias("c")).select(
        "id", text.number_count("c").cast("bigint").alias("number_count"))


@query("content_hash",
       f"{_A} SELECT id, md5({V.clean_sql('content')}) AS content_hash FROM articles")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).select(
        "id", text.content_hash(text.clean_text("content")).alias("content_hash"))


@query("preview",
       f"{_A} SELECT id, substr({V.clean_sql('content')}, 1, 250) AS preview FROM articles")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).select(
        "id", text.preview(text.clean_text("content")).alias("preview"))


@query("clean_statement", f"""{V.with_sql(V.CLAIMS)}
  SELECT id, {V.STATEMENT_SQL} AS statement FROM claims""")
def clean_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.claims(spark, sf_dir).select(
        "id", text.clean_statement("statement").alias("statement"))


@query("clean_statement_markup", f"""{V.with_sql(
    'claims AS (SELECT page_id AS id, html AS statement FROM pages)')}
  SELECT id, {V.STATEMENT_SQL} AS statement FROM claims""")
def clean_statement_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), text.clean_statement("html").alias("statement"))


@query("fill_text", f"""{_A} SELECT id, coalesce(type, '') AS type,
  coalesce(domain, '') AS domain, coalesce({V.strip_sql('title')}, '') AS title,
  coalesce(authors, '') AS authors, '' AS subtitle FROM articles""")
def fill_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).select(
        "id", text.fill_text("type").alias("type"), text.fill_text("domain").alias("domain"),
        text.fill_text("title", trim=True).alias("title"),
        text.fill_text("authors").alias("authors"),
        text.fill_text(F.lit(None)).alias("subtitle"),
    )


@query("combine_text_meta", f"""{_A} SELECT id, coalesce(domain, '') || ' ' ||
  coalesce(title, '') || ' ' || coalesce(authors, '') || ' ' || content AS combined
  FROM articles""")
def combine_text_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).select(
        "id", text.combine_text_and_meta("content").alias("combined"))


@query("liar_to_article", f"""{V.with_sql(V.CLAIMS, V.CLAIM_ARTICLES)}
  SELECT id, content, domain, title, authors,
    {V.claim_sql("lower(trim(claim_label))", C.CLAIM_RELIABLE, fake=1)} AS label
  FROM claim_articles WHERE label IS NOT NULL""")
def liar_to_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        V.claim_articles(spark, sf_dir)
        .withColumn("label", labels.map_claim_5way("claim_label", fake=1))
        .where(F.col("label").isNotNull()).drop("claim_label")
    )


@query("null_drop", f"""{_A} SELECT id, type FROM articles
  WHERE type IS NOT NULL AND title IS NOT NULL AND content IS NOT NULL""")
def null_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pressmill.operators.splitting import drop_unusable

    titled = drop_unusable(V.articles(spark, sf_dir), "type", "title")
    return cleaning.drop_null_text(titled).select("id", "type")


_TEXTS = """texts AS (
  SELECT doc_id AS id, text AS content FROM documents
  UNION ALL SELECT -1 - conv_id * 100 - turn, regexp_replace(text, '[b-zB-Z]', '', 'g')
  FROM conversations)"""


@query("empty_drop", f"""{V.with_sql(_TEXTS)} SELECT id, len({_KEPT}) AS kept_count
  FROM texts WHERE len({_KEPT}) > 0""")
def empty_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, and turns reduced to the letter a, which is often a stop word."""
    documents = V.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"))
    turns = V.table(spark, sf_dir, "conversations").select(
        (-1 - F.col("conv_id") * 100 - F.col("turn")).alias("id"),
        F.regexp_replace("text", "[b-zB-Z]", "").alias("content"))
    return cleaning.with_tokens(documents.unionByName(turns)).select(
        "id", F.size("kept").cast("bigint").alias("kept_count"))


def _phrases_sql(x: str, phrases) -> str:
    return " OR ".join(f"contains({x}, '{p}')" for p in phrases)


# The provided texts hold none of the fixed phrases, so a second query looks for
# letter sequences they do hold, one of them across a word border.
_PROBES = ("and the", "es de la", "tion un", "herthe")


@query("boilerplate_raw", f"""{_A}, normed AS (SELECT id,
    array_to_string({_TOKENS}, ' ') AS t FROM articles)
  SELECT id, {_phrases_sql('t', C.RAW_BOILERPLATE)} AS is_boilerplate,
    {_phrases_sql('t', _PROBES)} AS has_probe FROM normed""")
def boilerplate_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    normed = V.articles(spark, sf_dir).select(
        "id", text.normalize_for_phrase_match("content").alias("t"))
    return normed.select("id", quality.has_phrase("t").alias("is_boilerplate"),
                         quality.has_phrase("t", _PROBES).alias("has_probe"))


_WORD_STATS = f"""words AS (SELECT id, unnest({_KEPT}) AS w FROM articles),
  per_word AS (SELECT id, w, count(*) AS c FROM words GROUP BY id, w),
  token_stats AS (SELECT id, CAST(sum(c) AS BIGINT) AS n,
    count(*) / CAST(sum(c) AS DOUBLE) AS distinct_ratio,
    max(c) / CAST(sum(c) AS DOUBLE) AS top_ratio FROM per_word GROUP BY id)"""
_BAD_TOKENS = "n < 30 OR n > 1200 OR distinct_ratio < 0.28 OR top_ratio > 0.20"


@query("token_quality", f"""{_A}, {_WORD_STATS}
  SELECT id, n AS token_count, round(distinct_ratio, 6) AS distinct_ratio,
    round(top_ratio, 6) AS top_ratio, {_BAD_TOKENS} AS low_quality FROM token_stats""")
def token_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.with_tokens(V.articles(spark, sf_dir).select("id", "content"))
    return rounded(kept.select(
        "id", F.size("kept").alias("token_count"),
        quality.distinct_ratio("kept").alias("distinct_ratio"),
        quality.top_word_ratio("kept").alias("top_ratio"),
        quality.fails_token_quality("kept").alias("low_quality"),
    ))


@query("drop_ambiguous", f"""{_A} SELECT id, type FROM articles
  WHERE type IS NOT NULL AND type NOT IN {V.in_sql(C.AMBIGUOUS_TYPES)}""")
def drop_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).where(~labels.is_ambiguous("type")).select("id", "type")


@query("label_strict", f"""{_A} SELECT id, {V.strict_sql('type')} AS label FROM articles
  WHERE label IS NOT NULL""")
def label_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = V.articles(spark, sf_dir).select("id", labels.map_label_strict("type").alias("label"))
    return rounded(mapped.where(F.col("label").isNotNull()))


@query("label_normalized", f"""{_A}
  SELECT id, {V.strict_sql('lower(trim(type))', 1)} AS label_fake_1,
    {V.strict_sql('lower(trim(type))', 0)} AS label_fake_0 FROM articles""")
def label_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(V.articles(spark, sf_dir).select(
        "id", labels.map_label_normalized("type").alias("label_fake_1"),
        labels.map_label_normalized("type", fake=0).alias("label_fake_0")))


@query("liar_5way", f"""{V.with_sql(V.CLAIMS)}
  SELECT id, {V.claim_sql('lower(trim(label))', C.CLAIM_RELIABLE)} AS binary_label
  FROM claims""")
def liar_5way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(V.claims(spark, sf_dir).select(
        "id", labels.map_claim_5way("label").alias("binary_label")))


@query("liar_6way", f"""{V.with_sql(V.CLAIMS)}
  SELECT id, {V.claim_sql('label', C.CLAIM_RELIABLE + C.CLAIM_BORDERLINE)} AS binary_label
  FROM claims""")
def liar_6way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(V.claims(spark, sf_dir).select(
        "id", labels.map_claim_6way("label").alias("binary_label")))

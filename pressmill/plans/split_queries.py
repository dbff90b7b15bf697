"""Metadata join, deduplication, splits and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.functions import labels, text
from pressmill.operators import dedup, metadata, sampling, splitting
from pressmill.plans import views as V
from pressmill.plans.registry import query, rounded
from pressmill.session import materialize

_A = V.with_sql(V.ARTICLES)

META_ROWS = f"""meta AS (SELECT id,
    coalesce({V.strip_sql('domain')}, '') AS domain, coalesce({V.strip_sql('title')}, '') AS title,
    coalesce({V.strip_sql('authors')}, '') AS authors
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS r FROM raw_metadata)
  WHERE r = 1)"""
_META = META_ROWS + """,
  merged AS (SELECT a.id, a.type, m.domain, m.title, m.authors
    FROM articles a LEFT JOIN meta m ON m.id = a.id)"""
_MERGED = V.with_sql(V.ARTICLES, V.RAW_METADATA, _META)


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = V.articles(spark, sf_dir).select("id", "type")
    return metadata.merge_metadata(processed, V.raw_metadata(spark, sf_dir), order=["seq"])


@query("merge_metadata", f"{_MERGED} SELECT * FROM merged")
def merge_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)


def _coverage_sql(compat: bool) -> str:
    def test(c: str) -> str:
        return f"{c} IS NULL OR {c} <> ''" if compat else f"{c} <> ''"

    return " UNION ALL ".join(
        f"""SELECT '{c}' AS field, count(*) FILTER ({test(c)}) AS filled,
        round(100.0 * count(*) FILTER ({test(c)}) / CAST(count(*) AS DOUBLE), 6) AS percent,
        {str(compat).lower()} AS compat FROM merged"""
        for c in C.METADATA_COLUMNS)


@query("metadata_coverage",
       f"{_MERGED} {_coverage_sql(False)} UNION ALL {_coverage_sql(True)}")
def metadata_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _merged(spark, sf_dir)
    parts = [
        metadata.metadata_coverage(merged, compat=c).withColumn("compat", F.lit(c))
        for c in (False, True)
    ]
    return rounded(parts[0].unionByName(parts[1]))


_KEPT = V.kept_sql(V.tokens_sql("content"))


@query("dedup_content", f"""{_A}, p AS (SELECT id, type,
    array_to_string({_KEPT}, ' ') AS processed_text FROM articles WHERE type IS NOT NULL)
  SELECT id, type, md5(processed_text) AS text_md5 FROM (SELECT *, row_number() OVER
    (PARTITION BY md5(processed_text) ORDER BY id) AS r FROM p) WHERE r = 1""")
def dedup_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = V.articles(spark, sf_dir).select(
        "id", "type",
        text.join_tokens(text.remove_stopwords(text.tokenize_alpha("content")))
        .alias("processed_text"))
    unique = dedup.deduplicate_text(splitting.drop_unusable(processed))
    return unique.select("id", "type", F.md5("processed_text").alias("text_md5"))


@query("dedup_id", """SELECT conv_id AS id, turn, role, text FROM (SELECT *, row_number() OVER
  (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations) WHERE r = 1""")
def dedup_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = V.table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "id")
    return dedup.deduplicate_id(turns, order=["turn"])


def _split_sql(seed: int, name: str) -> str:
    return f"""{name} AS (SELECT id, type, CASE WHEN rn * 10 <= n * 8 THEN 'train'
    WHEN rn * 10 <= n * 9 THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY md5('{seed}:' || id), id) AS rn,
    count(*) OVER (PARTITION BY type) AS n FROM articles WHERE type IS NOT NULL))"""


_S = V.with_sql(V.ARTICLES, _split_sql(42, "splits"))


def _classed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).where(F.col("type").isNotNull()).select("id", "type")


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.stratified_split(_classed(spark, sf_dir))


@query("stratified_split", f"{_S} SELECT * FROM splits")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)


@query("split_report", f"""{_S} SELECT type, count(*) AS "full",
  count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val,
  count(*) FILTER (split = 'test') AS test FROM splits GROUP BY type""")
def split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_report(_split(spark, sf_dir))


@query("split_sizes", f"""{_S} SELECT split, count(*) AS n_rows, round(100.0 * count(*) /
  CAST((SELECT count(*) FROM splits) AS DOUBLE), 6) AS percent FROM splits GROUP BY split""")
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(splitting.split_sizes(_split(spark, sf_dir)))


def _shared_sql(source: str, a: str, b: str) -> str:
    return f"""SELECT '{a}_{b}' AS pair, count(*) AS overlap FROM
    (SELECT id FROM {source} WHERE split = '{a}' INTERSECT
     SELECT id FROM {source} WHERE split = '{b}')"""


_PAIRS = (("train", "val"), ("train", "test"), ("val", "test"))


@query("split_overlap",
       f"{_S} " + " UNION ALL ".join(_shared_sql("splits", a, b) for a, b in _PAIRS))
def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_overlap(_split(spark, sf_dir))


@query("split_overlap_two_seeds", V.with_sql(
    V.ARTICLES, _split_sql(42, "one"), _split_sql(7, "other"),
    "mixed AS (SELECT * FROM one UNION ALL SELECT * FROM other)")
    + " UNION ALL ".join(_shared_sql("mixed", a, b) for a, b in _PAIRS))
def split_overlap_two_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check on splits that do overlap: two seeds put together."""
    rows = materialize(_classed(spark, sf_dir), "classed")
    mixed = splitting.stratified_split(rows).unionByName(
        splitting.stratified_split(rows, seed=7))
    return splitting.split_overlap(mixed)


@query("shared_ids", V.with_sql(
    V.ARTICLES, _split_sql(42, "one"), _split_sql(7, "other"))
    + """SELECT id FROM one WHERE split = 'train' INTERSECT
    SELECT id FROM other WHERE split = 'test'""")
def shared_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(_classed(spark, sf_dir), "classed")
    one = splitting.stratified_split(rows).where("split = 'train'")
    other = splitting.stratified_split(rows, seed=7).where("split = 'test'")
    return splitting.shared_ids(one.unionByName(other), "train", "test")


@query("hash_sample", f"""{_A} SELECT id, type FROM (SELECT *, row_number() OVER
    (ORDER BY md5('42:' || id), id) AS r, count(*) OVER () AS n FROM articles)
  WHERE r <= round_even(0.1 * n, 0)""")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.random_sample(V.articles(spark, sf_dir).select("id", "type"), 0.1)


_L = f"l AS (SELECT id, CAST({V.strict_sql('type')} AS BIGINT) AS label FROM articles)"


@query("stratified_sample", f"""{V.with_sql(V.ARTICLES, _L)} SELECT id, label, fraction FROM
  (SELECT l.*, f.fraction, row_number() OVER (PARTITION BY label, fraction
     ORDER BY md5('42:' || id), id) AS r, count(*) OVER (PARTITION BY label, fraction) AS n
   FROM l, (VALUES (0.5::DOUBLE), (0.07::DOUBLE), (0.05::DOUBLE)) f(fraction)
   WHERE label IS NOT NULL)
  WHERE r <= round_even(fraction * n, 0)""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = materialize(rounded(V.articles(spark, sf_dir).select(
        "id", labels.map_label_strict("type").alias("label")
    ).where(F.col("label").isNotNull())), "labels")
    samples = sampling.stratified_samples(mapped, (0.5, 0.07, 0.05), ["label"])
    parts = [sample.withColumn("fraction", F.lit(f)) for f, sample in samples.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("fixed_sample", f"""{_A} SELECT id, type FROM articles
  ORDER BY md5('42:' || id), id LIMIT 400""")
def fixed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.fixed_size_sample(V.articles(spark, sf_dir).select("id", "type"), 400)


@query("concat_frames", f"""{V.with_sql(V.ARTICLES, V.CLAIMS, V.CLAIM_ARTICLES)}
  SELECT 'articles' AS origin, id, type, md5(content) AS content_md5, domain, title, authors
    FROM articles
  UNION ALL
  SELECT 'claims', id, claim_label, md5(content), domain, title, authors FROM claim_articles""")
def concat_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources put one after the other, columns matched by name."""
    own = V.articles(spark, sf_dir).drop("url").withColumn("origin", F.lit("articles"))
    other = V.claim_articles(spark, sf_dir).withColumnRenamed("claim_label", "type") \
        .withColumn("origin", F.lit("claims"))
    return own.unionByName(other).withColumn("content_md5", F.md5("content")).drop("content")

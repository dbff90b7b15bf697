"""The provided tables seen as articles, statements, metadata and predictions.

Each view exists twice, as a DataFrame and as SQL text; the SQL twins share the
patterns of the library only where both regex engines read them alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.functions import labels, text
from pressmill.operators.splitting import stratified_split
from pressmill.schemas import TABLES
from pressmill.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _author(id_column: str) -> Column:
    key = F.col(id_column)
    return F.when(key % 3 != 0, F.concat(F.lit("author "), (key % 11).cast("string")))


def _page_fields() -> list[Column]:
    return [
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("domain"),
        F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
    ]


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw articles, with a class, a URL and a date in the text."""
    n = F.substring("source", 4, 10).cast("int")
    kind = F.when(F.col("doc_id") % 97 == 13, F.lit(None)).when(n < 8, "reliable")
    names = ("fake", "unreliable", "conspiracy", "rumor", "junksci", "clickbait",
             "hate", "satire", "political", "bias", "unknown")
    for i, name in enumerate(names, start=8):
        kind = kind.when(n == i, name)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", *_page_fields())
    documents = table(spark, sf_dir, "documents")
    return documents.join(pages, F.col("page_id") == F.col("doc_id"), "left").select(
        F.col("doc_id").alias("id"),
        kind.otherwise(" Fake ").alias("type"),
        F.concat("text", F.lit(" "), F.coalesce("url", F.lit("")), F.lit(" "),
                 F.date_format(day, "yyyy-MM-dd")).alias("content"),
        "domain", "title", _author("doc_id").alias("authors"), "url",
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as labelled statements."""
    turns = table(spark, sf_dir, "conversations")
    names = ("true", "mostly-true", "half-true", "barely-true", "false", "pants-fire")
    which = (F.col("conv_id") + F.col("turn")) % 7
    label = F.when(which == 0, names[0])
    for i, name in enumerate(names[1:], start=1):
        label = label.when(which == i, name)
    return turns.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"),
        label.otherwise(" False ").alias("label"),
        F.col("text").alias("statement"), F.col("role").alias("subject"),
        F.concat(F.lit("speaker"), (F.col("conv_id") % 7).cast("string")).alias("speaker"),
    )


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata rows with stray spaces, NULLs and repeated ids; ``seq`` is file order."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.lit(0).cast("bigint").alias("seq"), *_page_fields(),
        _author("page_id").alias("authors"),
    ).withColumn("title", F.concat(F.lit("  "), "title", F.lit("\t")))
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), (F.col("turn") + 1).alias("seq"),
        F.concat(F.lit(" "), "role").alias("domain"), F.lit(None).cast("string").alias("title"),
        F.lit("").alias("authors"),
    )
    return pages.unionByName(turns)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and guesses that need no model."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("doc_id") % 5 == 0, "val").otherwise("test").alias("split"),
        (1 - F.col("quality")).alias("label"), F.col("toxic").alias("prediction"),
    )


def claim_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements, as they are, in the shape of processed articles; no publisher is known."""
    source = claims(spark, sf_dir)
    return source.select(
        "id", F.col("label").alias("claim_label"),
        text.fill_text("statement").alias("content"),
        F.lit("").alias("domain"), text.fill_text("subject").alias("title"),
        text.fill_text("speaker").alias("authors"),
    )


def labelled(spark: SparkSession, sf_dir: str, label: Column | None = None,
             columns: tuple[str, ...] = ("content",)) -> DataFrame:
    """Articles with a binary label, the strict one by default, split 80/10/10 within each.

    The split is written with the columns that are asked for: fitting and scoring
    read it several times.
    """
    mapped = articles(spark, sf_dir).withColumn(
        "label", labels.map_label_strict("type") if label is None else label)
    rows = mapped.where(F.col("label").isNotNull()).select("id", "label", *columns)
    return materialize(stratified_split(rows, "label"), "labelled")


# --- SQL twins ---------------------------------------------------------------

# Python whitespace for RE2, whose \s is ASCII only.
WS = (r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
STOP_SQL = ", ".join(f"'{w}'" for w in C.STOP_WORDS)


def in_sql(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def clean_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def tokens_sql(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z]+')"


def kept_sql(tokens: str) -> str:
    return f"list_filter({tokens}, lambda w: w NOT IN ({STOP_SQL}))"


def strict_sql(x: str, fake: int = 0) -> str:
    return (f"CASE WHEN {x} IN {in_sql(C.FAKE_TYPES)} THEN {fake} "
            f"WHEN {x} IN {in_sql(C.RELIABLE_TYPES)} THEN {1 - fake} END")


def claim_sql(x: str, reliable, fake: int = 0) -> str:
    return (f"CASE WHEN {x} IN {in_sql(C.CLAIM_FAKE)} THEN {fake} "
            f"WHEN {x} IN {in_sql(reliable)} THEN {1 - fake} END")


_AUTHOR_SQL = "CASE WHEN {0} % 3 <> 0 THEN 'author ' || CAST({0} % 11 AS VARCHAR) END"
_DOMAIN_SQL = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
_TITLE_SQL = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_KINDS = ("fake", "unreliable", "conspiracy", "rumor", "junksci", "clickbait", "hate",
          "satire", "political", "bias", "unknown")
_KIND_SQL = " ".join(f"WHEN n = {i} THEN '{k}'" for i, k in enumerate(_KINDS, start=8))

ARTICLES = f"""articles AS (
  SELECT d.doc_id AS id,
    CASE WHEN d.doc_id % 97 = 13 THEN NULL WHEN n < 8 THEN 'reliable' {_KIND_SQL}
         ELSE ' Fake ' END AS type,
    d.text || ' ' || coalesce(p.url, '') || ' ' ||
      strftime(DATE '2024-01-01' + CAST(d.doc_id % 365 AS INTEGER), '%Y-%m-%d') AS content,
    {_DOMAIN_SQL} AS domain, {_TITLE_SQL} AS title,
    {_AUTHOR_SQL.format('d.doc_id')} AS authors, p.url AS url
  FROM (SELECT *, CAST(substr(source, 4) AS INTEGER) AS n FROM documents) d
  LEFT JOIN pages p ON p.page_id = d.doc_id)"""

CLAIMS = """claims AS (
  SELECT conv_id * 100 + turn AS id,
    CASE (conv_id + turn) % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'mostly-true'
      WHEN 2 THEN 'half-true' WHEN 3 THEN 'barely-true' WHEN 4 THEN 'false'
      WHEN 5 THEN 'pants-fire' ELSE ' False ' END AS label,
    text AS statement, role AS subject,
    'speaker' || CAST(conv_id % 7 AS VARCHAR) AS speaker
  FROM conversations)"""

RAW_METADATA = f"""raw_metadata AS (
  SELECT page_id AS id, 0 AS seq, {_DOMAIN_SQL} AS domain,
    '  ' || {_TITLE_SQL} || chr(9) AS title, {_AUTHOR_SQL.format('page_id')} AS authors
  FROM pages
  UNION ALL
  SELECT conv_id, turn + 1, ' ' || role, NULL, '' FROM conversations)"""

PREDICTIONS = """predictions AS (
  SELECT doc_id AS id, CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'test' END AS split,
    1 - quality AS label, toxic AS prediction FROM labels)"""

STATEMENT_SQL = clean_sql(
    f"regexp_replace(regexp_replace(lower(statement), 'http[^{WS}]+|www\\.[^{WS}]+', ' ', 'g'), "
    r"'<[^\n]*?>', ' ', 'g')"
)
CLAIM_ARTICLES = f"""claim_articles AS (
  SELECT id, label AS claim_label, coalesce(statement, '') AS content, '' AS domain,
    coalesce(subject, '') AS title, coalesce(speaker, '') AS authors FROM claims)"""

# Letters outside ASCII count as word characters, but RE2's \b does not know
# them; a stand-in letter that starts no month name makes the borders agree.
_FOLDED = f"regexp_replace({clean_sql('content')}, '[À-ÖØ-öø-ɏ]', 'q', 'g')"
_DATES = (
    r"\b\d{4}-\d{1,2}-\d{1,2}\b", r"\b\d{1,2}/\d{1,2}/\d{2,4}\b",
    r"\b\d{1,2}-\d{1,2}-\d{2,4}\b",
    rf"(?i)\b(?:{'|'.join(C.MONTH_NAMES)})\s+\d{{1,2}}(?:,\s*\d{{4}})?\b",
)


def count_sql(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


URLS_SQL = count_sql(clean_sql("content"), r"(?i)https?://\S+|www\.\S+")
DATES_SQL = " + ".join(count_sql(_FOLDED, p) for p in _DATES)
NUMBERS_SQL = count_sql(_FOLDED, r"\b\d+(?:[.,]\d+)?\b")

FEATURES = f"""features AS (
  SELECT id, coalesce(type, 'nan') AS type,
    coalesce({clean_sql('title')}, '') AS title, coalesce({clean_sql('domain')}, '') AS domain,
    coalesce({clean_sql('url')}, '') AS url, {clean_sql('content')} AS content,
    {tokens_sql('content')} AS tokens, len({tokens_sql('content')}) AS token_count,
    {URLS_SQL} AS url_count, {DATES_SQL} AS date_count, {NUMBERS_SQL} AS number_count
  FROM articles WHERE len({tokens_sql('content')}) > 0)"""

def labelled_sql(label: str, source: str = "articles", stratum: str = "label") -> str:
    """``labelled``: rows of ``source`` with a label and their split within ``stratum``."""
    return f"""labelled AS (
  SELECT *, CASE WHEN rn * 10 <= n * 8 THEN 'train' WHEN rn * 10 <= n * 9 THEN 'val'
                 ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY md5('42:' || id), id) AS rn,
               count(*) OVER (PARTITION BY {stratum}) AS n
        FROM (SELECT *, {label} AS label FROM {source})
        WHERE label IS NOT NULL))"""


def normalized_sql(x: str, fake: int = 1) -> str:
    return strict_sql(f"lower({strip_sql(x)})", fake)


LABELLED = labelled_sql(strict_sql("type"))


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

"""Everything that depends on stems, and the linear models.

The SQL twins stem with an independent formulation of the same algorithm: one
chain of CASE expressions per step over the distinct words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.functions import labels, quality, text
from pressmill.operators import (
    cleaning, evaluation, linear, linear_table, profile, stemming, stochastic,
)
from pressmill.operators.dedup import deduplicate_text
from pressmill.operators.features import term_weights
from pressmill.plans import views as V
from pressmill.plans.model_queries import (
    BIGRAM_FIELD, BLOCK_FIELDS, META, TITLE_FIELD, metric_sql, tf_sql, train_rows, vocab_sql,
    weight_sql,
)
from pressmill.plans.profile_queries import KEPT_ROWS
from pressmill.plans.registry import query, rounded
from pressmill.session import materialize

# --- Stemming in SQL ---------------------------------------------------------

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_POSITIVE = f"^({_C})?{_V}{_C}"
_ONE = f"^({_C})?{_V}{_C}({_V})?$"
_MANY = f"^({_C})?{_V}{_C}{_V}{_C}"
_CVC = "((^y|[aeiou]y|[^aeiouy])[aeiouy][^aeiouwxy]$)|^[aeiou][^aeiou]$"


def _cut(x: str, n: int) -> str:
    return f"left({x}, length({x}) - {n})"


def _is(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '{pattern}')"


def _suffix_cases(x: str, rules, condition: str) -> str:
    """CASE branches, longest suffix first; a failed condition keeps the word."""
    branches = []
    for suffix, replacement in sorted(rules, key=lambda r: -len(r[0])):
        stem = _cut(x, len(suffix))
        branches.append(f"WHEN ends_with({x}, '{suffix}') THEN CASE WHEN {_is(stem, condition)} "
                        f"THEN {stem} || '{replacement}' ELSE {x} END")
    return " ".join(branches)


_ENDINGS = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"),
    ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
# Irregular forms.
_FORMS = (
    ("sky", "sky"), ("skies", "sky"), ("dying", "die"), ("lying", "lie"), ("tying", "tie"),
    ("news", "news"), ("innings", "inning"), ("inning", "inning"), ("outings", "outing"),
    ("outing", "outing"), ("cannings", "canning"), ("canning", "canning"), ("howe", "howe"),
    ("proceed", "proceed"), ("exceed", "exceed"), ("succeed", "succeed"),
)


def _steps_sql(source: str) -> list[str]:
    """``stem_of``: word, stem for the column ``word`` of ``source``."""
    doubled = "".join(f"{c}{c}|" for c in "bcdfghjkmnpqrtvwx").rstrip("|")
    step_4 = " ".join(
        f"WHEN ends_with(w, '{s}') THEN CASE WHEN {_is(_cut('w', len(s)), _MANY)}"
        + (f" AND {_is(_cut('w', 3), '[st]$')}" if s == "ion" else "")
        + f" THEN {_cut('w', len(s))} ELSE w END"
        for s in sorted(("al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous "
                         "ive ize").split(), key=lambda s: -len(s))
    )
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _FORMS)
    return [
        f"step_1a AS (SELECT word, CASE WHEN word LIKE '_ies' THEN {_cut('word', 1)} "
        f"WHEN {_is('word', '(sses|ies)$')} THEN {_cut('word', 2)} "
        f"WHEN {_is('word', '[^s]s$')} OR word = 's' THEN {_cut('word', 1)} ELSE word END AS w "
        f"FROM (SELECT DISTINCT word FROM {source}))",
        f"step_1b AS (SELECT *, CASE WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 "
        f"THEN {_cut('w', 1)} ELSE {_cut('w', 2)} END "
        f"WHEN ends_with(w, 'eed') THEN CASE WHEN {_is(_cut('w', 3), _POSITIVE)} "
        f"THEN {_cut('w', 1)} ELSE w END END AS done, "
        f"CASE WHEN ends_with(w, 'ed') AND {_is(_cut('w', 2), '[aeiou]|.y')} THEN {_cut('w', 2)} "
        f"WHEN ends_with(w, 'ing') AND {_is(_cut('w', 3), '[aeiou]|.y')} THEN {_cut('w', 3)} END "
        "AS r FROM step_1a)",
        f"step_1 AS (SELECT word, CASE WHEN done IS NOT NULL THEN done WHEN r IS NULL THEN w "
        f"WHEN {_is('r', '(at|bl|iz)$')} THEN r || 'e' "
        f"WHEN {_is('r', '(' + doubled + ')$')} THEN {_cut('r', 1)} "
        f"WHEN {_is('r', '(ll|ss|zz)$')} THEN r "
        f"WHEN {_is('r', _ONE)} AND {_is('r', _CVC)} THEN r || 'e' ELSE r END AS w FROM step_1b)",
        f"step_1c AS (SELECT word, CASE WHEN {_is('w', '.([^aeiouy]|[aeiou]y)y$')} "
        f"OR {_is('w', '^y?[^aeiouy]+[^aeiouy]y$')} THEN {_cut('w', 1)} || 'i' ELSE w END AS w "
        "FROM step_1)",
        # The ending "alli" is shortened first and the result looked at again.
        f"step_2a AS (SELECT word, CASE WHEN ends_with(w, 'alli') AND "
        f"{_is(_cut('w', 4), _POSITIVE)} THEN {_cut('w', 2)} ELSE w END AS w, "
        f"ends_with(w, 'alli') AND NOT {_is(_cut('w', 4), _POSITIVE)} AS fixed FROM step_1c)",
        f"step_2 AS (SELECT word, CASE WHEN fixed THEN w "
        f"WHEN ends_with(w, 'logi') THEN CASE WHEN {_is(_cut('w', 3), _POSITIVE)} "
        f"THEN {_cut('w', 1)} ELSE w END {_suffix_cases('w', _ENDINGS, _POSITIVE)} "
        "ELSE w END AS w FROM step_2a)",
        "step_3 AS (SELECT word, CASE " + _suffix_cases("w", (
            ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
            ("ful", ""), ("ness", "")), _POSITIVE) + " ELSE w END AS w FROM step_2)",
        f"step_4 AS (SELECT word, CASE {step_4} ELSE w END AS w FROM step_3)",
        f"step_5 AS (SELECT word, CASE WHEN ends_with(w, 'e') AND ({_is(_cut('w', 1), _MANY)} OR "
        f"({_is(_cut('w', 1), _ONE)} AND NOT {_is(_cut('w', 1), _CVC)})) THEN {_cut('w', 1)} "
        "ELSE w END AS w FROM step_4)",
        f"stem_of AS (SELECT word, CASE word {irregular} ELSE CASE WHEN length(word) <= 2 "
        f"THEN word WHEN ends_with(w, 'll') AND {_is(_cut('w', 1), _MANY)} THEN {_cut('w', 1)} "
        "ELSE w END END AS stem FROM step_5)",
    ]


_WORDS = f"""placed AS (SELECT id, type, unnest(kept) AS word, generate_subscripts(kept, 1) AS pos
    FROM (SELECT id, type, {V.kept_sql(V.tokens_sql('content'))} AS kept FROM articles))"""
_TEXTS = """stemmed AS (SELECT id, any_value(type) AS type,
    string_agg(stem, ' ' ORDER BY pos) AS processed_text
  FROM placed JOIN stem_of USING (word) GROUP BY id)"""
_STEMMED = [V.ARTICLES, _WORDS, *_steps_sql("placed"), _TEXTS]


# --- Stems of texts ----------------------------------------------------------

@query("stemmed_text", V.with_sql(*_STEMMED) + "SELECT id, processed_text FROM stemmed")
def stemmed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.with_tokens(V.articles(spark, sf_dir).select("id", "content"))
    return kept.select("id", stemming.stem_text(text.join_tokens("kept")).alias("processed_text"))


_PROBES = ("of the", "tion and", "thi the")


def _any_sql(x: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({x}, '{p}')" for p in phrases) + ")"


@query("boilerplate_stemmed", V.with_sql(*_STEMMED)
       + f"""SELECT id, {_any_sql('processed_text', C.STEMMED_BOILERPLATE)} AS is_boilerplate,
    {_any_sql('processed_text', _PROBES)} AS has_probe FROM stemmed""")
def boilerplate_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    stems = stemmed_text(spark, sf_dir)
    return stems.select(
        "id", quality.has_phrase("processed_text", C.STEMMED_BOILERPLATE).alias("is_boilerplate"),
        quality.has_phrase("processed_text", _PROBES).alias("has_probe"))


_CLEAN = f"""clean AS (SELECT id, type, processed_text FROM stemmed
    WHERE id IN (SELECT id FROM kept_rows)
    AND NOT {_any_sql('processed_text', C.STEMMED_BOILERPLATE)})"""
CLEANED = [*_STEMMED, KEPT_ROWS, _CLEAN]


@query("processed_articles", V.with_sql(*CLEANED) + "SELECT * FROM clean")
def processed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.processed_articles(V.articles(spark, sf_dir))


DROP_REASONS = f"""SELECT s.id, c.id IS NULL AS low_quality,
    CASE WHEN {_any_sql("array_to_string(t.tokens, ' ')", C.RAW_BOILERPLATE)} THEN 'boilerplate'
      WHEN k.id IS NULL THEN 'tokens' WHEN c.id IS NULL THEN 'stemmed_boilerplate' END
      AS drop_reason
  FROM stemmed s JOIN tokenized t ON t.id = s.id LEFT JOIN kept_rows k ON k.id = s.id
  LEFT JOIN clean c ON c.id = s.id"""


@query("low_quality", V.with_sql(*CLEANED) + DROP_REASONS)
def low_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.quality_report(V.articles(spark, sf_dir))


@query("dedup_processed", V.with_sql(*CLEANED) + """SELECT id, type, md5(processed_text)
  AS text_md5 FROM (SELECT *, row_number() OVER (PARTITION BY md5(processed_text) ORDER BY id)
  AS r FROM clean WHERE type IS NOT NULL) WHERE r = 1""")
def dedup_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = cleaning.processed_articles(V.articles(spark, sf_dir))
    unique = deduplicate_text(processed.where(F.col("type").isNotNull()))
    return unique.select("id", "type", F.md5("processed_text").alias("text_md5"))


@query("sample_rows_stemmed", V.with_sql(*_STEMMED, V.FEATURES) + """SELECT f.id, f.type,
    f.title, f.domain, f.url, f.content, f.token_count, f.url_count, f.date_count,
    f.number_count, coalesce(s.processed_text, '') AS processed_text
  FROM features f LEFT JOIN stemmed s ON s.id = f.id ORDER BY f.id LIMIT 1000""")
def sample_rows_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = profile.first_articles(V.articles(spark, sf_dir))
    return cleaning.sample_rows_with_stems(profile.analyzed(chosen, tokens=True))


# --- Stemmed vocabularies ----------------------------------------------------

_CLEAN_WORDS = [
    "raw_words AS (SELECT unnest(tokens) AS word FROM tokenized WHERE id IN (SELECT id FROM clean))",
    "stem_words AS (SELECT s.stem FROM raw_words r JOIN stem_of s ON s.word = r.word "
    f"WHERE r.word NOT IN ({V.STOP_SQL}))",
    f"""sizes AS (SELECT (SELECT count(DISTINCT word) FROM raw_words) AS vocab_raw,
      (SELECT count(DISTINCT word) FROM raw_words WHERE word NOT IN ({V.STOP_SQL}))
        AS vocab_no_stop,
      (SELECT count(DISTINCT stem) FROM stem_words) AS vocab_stemmed,
      (SELECT count(*) FROM raw_words) AS tokens_raw,
      (SELECT count(*) FROM stem_words) AS tokens_no_stop,
      (SELECT count(*) FROM stem_words) AS tokens_stemmed)""",
]


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.vocabulary_sizes(cleaning.clean_articles(V.articles(spark, sf_dir)))


@query("vocab_sizes_stemmed", V.with_sql(*CLEANED, *_CLEAN_WORDS) + "SELECT * FROM sizes")
def vocab_sizes_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sizes(spark, sf_dir)


@query("vocab_reduction", V.with_sql(*CLEANED, *_CLEAN_WORDS) + """SELECT
    round(100.0 * (vocab_raw - vocab_no_stop) / CAST(vocab_raw AS DOUBLE), 6)
      AS stopword_reduction,
    round(100.0 * (vocab_no_stop - vocab_stemmed) / CAST(vocab_no_stop AS DOUBLE), 6)
      AS stemming_reduction FROM sizes""")
def vocab_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cleaning.vocabulary_reduction(_sizes(spark, sf_dir)))


_STEM_COUNTS = """stem_counts AS (SELECT stem AS word, count(*) AS "count"
    FROM placed JOIN stem_of USING (word) GROUP BY stem)"""
_COUNTED = V.with_sql(V.ARTICLES, _WORDS, *_steps_sql("placed"), _STEM_COUNTS)


def _stem_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = V.articles(spark, sf_dir).select(text.tokenize_alpha("content").alias("tokens"))
    return cleaning.stemmed_word_counts(cleaning.word_counts(tokens))


@query("word_freq_stemmed", f"{_COUNTED} SELECT * FROM stem_counts")
def word_freq_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stem_counts(spark, sf_dir)


@query("top_words_stemmed", f"""{_COUNTED} SELECT * FROM stem_counts
  ORDER BY "count" DESC, word LIMIT 100""")
def top_words_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_words(_stem_counts(spark, sf_dir))


@query("rank_frequency_stemmed", f"""{_COUNTED} SELECT
  row_number() OVER (ORDER BY "count" DESC, word) AS rank, word, "count" AS frequency
  FROM stem_counts ORDER BY rank LIMIT 10000""")
def rank_frequency_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.rank_frequency(_stem_counts(spark, sf_dir))


# --- Linear models -----------------------------------------------------------
# What an optimiser returns has no SQL twin. What can be said of it has: it is a
# stationary point, scores follow from coefficients, and the grid's choice from scores.

_KEEP = ("id", "split", "label")


def _vectors(rows: DataFrame, fields) -> tuple[DataFrame, linear.Vectorizer]:
    vectorizer = linear.fit_vectorizer(train_rows(rows), fields)
    return linear.vectorize(rows, vectorizer, _KEEP), vectorizer


def _logistic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels after trimming and lower-casing, fake 1."""
    return V.labelled(spark, sf_dir, labels.map_label_normalized("type", fake=1), META)


_LOGISTIC = V.labelled_sql(V.normalized_sql("type", fake=1))


@query("feature_vectors", V.with_sql(
    V.ARTICLES, V.LABELLED, *tf_sql(BLOCK_FIELDS, "labelled"),
    *vocab_sql(BLOCK_FIELDS, "labelled"), *weight_sql(BLOCK_FIELDS),
    "indexed AS (SELECT field, term, row_number() OVER (ORDER BY field, term) AS pos FROM vocab)")
    + """SELECT l.id, (SELECT count(*) FROM vocab) AS size, count(i.pos) AS entries,
    coalesce(min(i.pos) - 1, -1) AS first_index,
    round(coalesce(sum(w.weight * i.pos), 0) / (SELECT count(*) FROM vocab), 6) AS checksum
  FROM labelled l LEFT JOIN w ON w.id = l.id
  LEFT JOIN indexed i ON i.field = w.field AND i.term = w.term GROUP BY l.id""")
def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, entries and a position-weighted checksum of each sparse vector."""
    rows = V.labelled(spark, sf_dir, columns=META)
    vectorizer = linear.fit_vectorizer(train_rows(rows), BLOCK_FIELDS)
    vectors = linear.sparse_rows(rows, vectorizer, ("id",))
    products = F.zip_with("features.indices", "features.values", lambda i, v: (i + 1) * v)
    total = F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
    return rounded(vectors.select(
        "id", F.col("features.size").alias("size"),
        F.size("features.indices").alias("entries"),
        F.coalesce(F.get("features.indices", F.lit(0)), F.lit(-1)).alias("first_index"),
        (total / F.col("features.size")).alias("checksum")))


_FORMULA_SQL = "((('0x' || substr(md5(field || ':' || term), 1, 8))::BIGINT % 2001) - 1000) / 250.0"
_INTERCEPT = 0.05


def _formula_model(vectorizer: linear.Vectorizer, logistic: bool) -> linear.TermModel:
    """A model whose coefficients follow from the terms alone."""
    code = F.conv(F.substring(F.md5(F.concat("field", F.lit(":"), "term")), 1, 8), 16, 10)
    coefficient = (code.cast("bigint") % 2001 - 1000) / F.lit(250.0)
    terms = vectorizer.vocabulary.select("idx", coefficient.alias("w"))
    return linear.TermModel(terms, _INTERCEPT, vectorizer.size, logistic)


def _formula_sql(label_cte: str, fields) -> str:
    return V.with_sql(
        V.ARTICLES, label_cte, *tf_sql(fields, "labelled"), *vocab_sql(fields, "labelled"),
        *weight_sql(fields),
        f"""margins AS (SELECT l.id, l.split, CAST(l.label AS BIGINT) AS label,
          coalesce(d.dot, 0) + {_INTERCEPT} AS margin FROM labelled l LEFT JOIN
          (SELECT id, sum(weight * {_FORMULA_SQL}) AS dot FROM w GROUP BY id) d ON d.id = l.id)""")


@query("linear_predict", _formula_sql(V.LABELLED, [BIGRAM_FIELD])
       + "SELECT id, split, label, CAST(margin > 0 AS BIGINT) AS prediction FROM margins")
def linear_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by given coefficients, for the hinge-loss model."""
    vectors, vectorizer = _vectors(V.labelled(spark, sf_dir), [BIGRAM_FIELD])
    model = _formula_model(vectorizer, logistic=False)
    return rounded(linear.predict(model, vectors, _KEEP))


@query("logistic_predict", _formula_sql(_LOGISTIC, BLOCK_FIELDS)
       + """SELECT id, split, label, round(1 / (1 + exp(-margin)), 6) AS probability,
    CAST(1 / (1 + exp(-margin)) >= 0.5 AS BIGINT) AS prediction FROM margins""")
def logistic_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities by given coefficients over the four feature blocks."""
    vectors, vectorizer = _vectors(_logistic_rows(spark, sf_dir), BLOCK_FIELDS)
    model = _formula_model(vectorizer, logistic=True)
    return rounded(linear.predict_probability(model, vectors, _KEEP))


def _certificate_sql(label_cte: str, fields) -> str:
    return V.with_sql(V.ARTICLES, label_cte, *tf_sql(fields, "labelled"),
                      *vocab_sql(fields, "labelled")) + """SELECT
    (SELECT count(*) FROM labelled WHERE split = 'train') AS n_rows,
    (SELECT count(*) FROM vocab) AS n_terms, true AS stationary, true AS lowest"""


@query("svm_fit", _certificate_sql(V.LABELLED, [BIGRAM_FIELD]))
def svm_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted hinge-loss model against nearby coefficients, over the table of weights."""
    rows = V.labelled(spark, sf_dir)
    vectors, vectorizer = _vectors(rows, [BIGRAM_FIELD])
    model = linear.fit_svm(vectors.where("split = 'train'"))
    return linear.certificate(model, train_rows(rows), vectorizer, "hinge")


@query("svm_title_fit", _certificate_sql(V.LABELLED, [BIGRAM_FIELD, TITLE_FIELD]))
def svm_title_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for two feature blocks, text and title."""
    fields = [BIGRAM_FIELD, TITLE_FIELD]
    rows = V.labelled(spark, sf_dir, columns=META)
    vectors, vectorizer = _vectors(rows, fields)
    model = linear.fit_svm(vectors.where("split = 'train'"))
    return linear.certificate(model, train_rows(rows), vectorizer, "hinge")


@query("logistic_fit", _certificate_sql(_LOGISTIC, BLOCK_FIELDS))
def logistic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted logistic model: its gradient, and nearby coefficients."""
    rows = _logistic_rows(spark, sf_dir)
    vectors, vectorizer = _vectors(rows, BLOCK_FIELDS)
    train = vectors.where("split = 'train'")
    n = train.count()
    model = linear.fit_logistic(train, 1.0, n)
    return linear.certificate(model, train_rows(rows), vectorizer, "log", penalty=1.0 / n)


@query("linear_svc")
def linear_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hinge-loss model on unigrams and bigrams; metrics per split, fake positive."""
    vectors, _ = _vectors(V.labelled(spark, sf_dir), [BIGRAM_FIELD])
    model = linear.fit_svm(vectors.where("split = 'train'"))
    return rounded(evaluation.metrics_by_split(linear.predict(model, vectors, _KEEP)))


@query("linear_svc_title")
def linear_svc_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on two blocks, text and title."""
    vectors, _ = _vectors(V.labelled(spark, sf_dir, columns=META), [BIGRAM_FIELD, TITLE_FIELD])
    model = linear.fit_svm(vectors.where("split = 'train'"))
    return rounded(evaluation.metrics_by_split(linear.predict(model, vectors, _KEEP)))


@query("svm_cross_domain")
def svm_cross_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hinge-loss model on every split and, unchanged, on the statements.

    Articles and statements are cleaned alike; labels are trimmed and lower-cased.
    """
    rows = V.labelled(spark, sf_dir, labels.map_label_normalized("type", fake=0)) \
        .withColumn("content", text.clean_statement("content"))
    vectors, vectorizer = _vectors(materialize(rows, "cleaned"), [BIGRAM_FIELD])
    model = linear.fit_svm(vectors.where("split = 'train'"))
    own = linear.predict(model, vectors, _KEEP)
    statements = _statements(spark, sf_dir, fake=0) \
        .withColumn("content", text.clean_statement("content"))
    other = linear.predict(model, linear.vectorize(statements, vectorizer, _KEEP), _KEEP)
    return rounded(evaluation.metrics_by_split(own.unionByName(other)))


def _statements(spark: SparkSession, sf_dir: str, fake: int) -> DataFrame:
    """Non-empty statements with a 5-way label, as one more split."""
    return (
        V.claim_articles(spark, sf_dir)
        .withColumn("label", labels.map_claim_5way("claim_label", fake=fake))
        .where(F.col("label").isNotNull() & (F.length("content") > 0))
        .withColumn("split", F.lit("claims"))
    )


@query("logistic_grid")
def logistic_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation F1 for every C on the four feature blocks."""
    vectors, _ = _vectors(_logistic_rows(spark, sf_dir), BLOCK_FIELDS)
    result = linear.logistic_grid(vectors.where("split = 'train'"), vectors.where("split = 'val'"))
    return rounded(result.table(spark))


_GUESS_SQL = " UNION ALL ".join(
    f"SELECT {i} AS position, {c} AS c, label, (id * {7 + 3 * i}) % 11 % 2 AS prediction FROM predictions"
    for i, c in enumerate(C.C_GRID))


@query("grid_choice", V.with_sql(V.PREDICTIONS, f"guesses AS ({_GUESS_SQL})",
    f"m AS ({metric_sql('guesses', 'position', 1)})") + """SELECT position, c::DOUBLE AS c, f1,
    position = (SELECT position FROM m ORDER BY f1 DESC, position LIMIT 1) AS chosen
  FROM m JOIN (SELECT DISTINCT position, c FROM guesses) USING (position)""")
def grid_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule that picks a C, over guesses that need no model."""
    known = V.predictions(spark, sf_dir)
    scores = []
    for i, c in enumerate(C.C_GRID):
        guessed = known.withColumn("prediction", (F.col("id") * (7 + 3 * i)) % 11 % 2)
        scores.append((c, linear.validation_f1(guessed, pos_label=1)))
    return rounded(linear.choose(scores).table(spark))


def _cells(rows: DataFrame, fields) -> DataFrame:
    """Weights of all rows as ``id, split, label, idx, weight``."""
    vectorizer = linear.fit_vectorizer(train_rows(rows), fields)
    weights = term_weights(rows, vectorizer.vocabulary, fields, _KEEP, extra=["idx"])
    return materialize(weights.select(*_KEEP, "idx", "weight"), "cells")


_STEPS, _RATE = 3, 1.0


def _descent_sql() -> str:
    """The same steps in SQL: coefficients, intercepts and margins of every step, for all c together."""
    rows = "(SELECT id, label FROM labelled WHERE split = 'train')"
    n = f"(SELECT count(*) FROM {rows})"
    grid = ", ".join(f"({i}, CAST({c} AS DOUBLE))" for i, c in enumerate(C.C_GRID))
    ctes = [f"grid(position, c) AS (VALUES {grid})",
            "w_0 AS (SELECT position, field, term, CAST(0 AS DOUBLE) AS w FROM grid, vocab)",
            "b_0 AS (SELECT position, CAST(0 AS DOUBLE) AS b FROM grid)"]
    for k in range(_STEPS + 1):
        ctes.append(f"m_{k} AS (SELECT l.id, l.split, CAST(l.label AS BIGINT) AS label, b.position, b.b + coalesce(d.dot, 0) AS m "
                    f"FROM labelled l CROSS JOIN b_{k} b LEFT JOIN (SELECT w.id, c.position, sum(w.weight * c.w) AS dot FROM w "
                    f"JOIN w_{k} c ON c.field = w.field AND c.term = w.term GROUP BY w.id, c.position) d "
                    "ON d.id = l.id AND d.position = b.position)")
        if k == _STEPS:
            break
        ctes += [
            f"r_{k} AS (SELECT id, position, (1 / (1 + exp(-m)) - label) / {n} AS r FROM m_{k} WHERE split = 'train')",
            f"g_{k} AS (SELECT r.position, w.field, w.term, sum(w.weight * r.r) AS g FROM w JOIN r_{k} r ON r.id = w.id GROUP BY ALL)",
            f"w_{k + 1} AS (SELECT o.position, o.field, o.term, o.w - {_RATE} * (coalesce(g.g, 0) + o.w / (q.c * {n})) AS w "
            f"FROM w_{k} o JOIN grid q ON q.position = o.position LEFT JOIN g_{k} g ON g.position = o.position "
            "AND g.field = o.field AND g.term = o.term)",
            f"b_{k + 1} AS (SELECT o.position, any_value(o.b) - {_RATE} * sum(r.r) AS b FROM b_{k} o JOIN r_{k} r "
            "ON r.position = o.position GROUP BY o.position)"]
    loss = "greatest(0, -(2 * label - 1) * m) + ln(1 + exp(-abs(m)))"
    ctes += [
        f"guesses AS (SELECT position, label, CAST(m >= 0 AS BIGINT) AS prediction FROM m_{_STEPS} WHERE split = 'val')",
        f"f AS ({metric_sql('guesses', 'position', 1)})",
        f"losses AS (SELECT position, avg({loss}) AS loss FROM m_{_STEPS} WHERE split = 'train' GROUP BY position)",
        f"squares AS (SELECT position, sum(w * w) AS ww FROM w_{_STEPS} GROUP BY position)"]
    return V.with_sql(V.ARTICLES, _LOGISTIC, *tf_sql(BLOCK_FIELDS, "labelled"), *vocab_sql(BLOCK_FIELDS, "labelled"),
                      *weight_sql(BLOCK_FIELDS), *ctes) + f"""SELECT q.position, q.c, f.f1,
    round(l.loss + s.ww / (2 * q.c * {n}), 6) AS objective,
    q.position = (SELECT position FROM f ORDER BY f1 DESC, position LIMIT 1) AS chosen
  FROM grid q JOIN f USING (position) JOIN losses l USING (position) JOIN squares s USING (position)"""


@query("logistic_grid_steps", _descent_sql())
def logistic_grid_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed number of full-batch steps for every C together, coefficients as a table; validation F1."""
    rows = _logistic_rows(spark, sf_dir)
    cells = _cells(rows, BLOCK_FIELDS)
    train = train_rows(rows).select("id", "label")
    model = linear_table.descend(cells.where("split = 'train'"), train, C.C_GRID, _STEPS, _RATE)
    held = rows.where("split = 'val'").select("id", "label")
    scores = model.validation_f1(cells.where("split = 'val'"), held)
    table = linear.choose(list(zip(C.C_GRID, scores))).table(spark)
    objectives = spark.createDataFrame(list(enumerate(model.objectives)), "position int, objective double")
    return rounded(table.join(objectives, "position"))


@query("svm_epochs", V.with_sql(V.ARTICLES, V.LABELLED, *tf_sql([BIGRAM_FIELD], "labelled"),
                               *vocab_sql([BIGRAM_FIELD], "labelled")) + """SELECT split, count(*) AS n_rows,
    (SELECT count(*) FROM vocab) AS n_terms, CASE WHEN split = 'train' THEN true END AS learnt FROM labelled GROUP BY split""")
def svm_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three epochs of stochastic steps; whether they put three of four training rows on the right side."""
    rows = V.labelled(spark, sf_dir)
    vectors, vectorizer = _vectors(rows, [BIGRAM_FIELD])
    sparse = linear.sparse_rows(train_rows(rows), vectorizer, _KEEP)
    model = stochastic.fit_epochs(sparse, vectorizer.size)
    right = F.avg((F.col("prediction") == F.col("label")).cast("int")) >= 0.75
    return linear.predict(model, vectors, _KEEP).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(vectorizer.size).cast("bigint").alias("n_terms"),
        F.when(F.first("split") == "train", right).alias("learnt"))


@query("logistic_cross_domain")
def logistic_cross_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen model on every split and, unchanged, on the statements as they are."""
    vectors, vectorizer = _vectors(_logistic_rows(spark, sf_dir), BLOCK_FIELDS)
    result = linear.logistic_grid(vectors.where("split = 'train'"), vectors.where("split = 'val'"))
    foreign = linear.vectorize(_statements(spark, sf_dir, fake=1), vectorizer, _KEEP)
    own = linear.predict_probability(result.model, vectors, _KEEP)
    other = linear.predict_probability(result.model, foreign, _KEEP)
    return rounded(evaluation.metrics_by_split(own.unionByName(other), pos_label=1))

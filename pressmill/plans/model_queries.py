"""TF-IDF features, naive Bayes, and evaluation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.functions import labels, text
from pressmill.functions.pinning import pin
from pressmill.operators import bayes, evaluation, features
from pressmill.operators.sampling import random_sample
from pressmill.plans import views as V
from pressmill.plans.registry import query, r6, rounded
from pressmill.session import materialize

# The settings of the baselines, over the text that the test tables have.
NB_FIELD = replace(features.NB_TEXT, column="content")
META_FIELD = features.NB_COMBINED
BIGRAM_FIELD = replace(features.SVM_TEXT, column="content")
TITLE_FIELD = features.SVM_TITLE
BLOCK_FIELDS = tuple(
    replace(f, column="content") if f.name == "text" else f for f in features.LOGISTIC_FIELDS)
META = ("content", *C.METADATA_COLUMNS)
KEEP = ("id", "split", "label")


def train_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("split") == "train")


# --- SQL twins ---------------------------------------------------------------

_WORD_SQL = r"[\p{L}\p{N}_]{2,}"


def _fold_sql(x: str) -> str:
    """Lower case, diacritics gone, other letters outside ASCII made digits.

    A digit is a word character but not a letter, so RE2's ASCII word border
    falls where the Unicode one does.
    """
    return f"regexp_replace(strip_accents(lower({x})), '[À-ÖØ-öø-ɏ]', '0', 'g')"


def _grams_sql(tokens: str, two: bool) -> str:
    if not two:
        return tokens
    return (f"list_concat({tokens}, list_transform(range(1, len({tokens})), "
            f"lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]))")


def _field_tokens_sql(f: features.Field) -> str:
    column = f"coalesce({f.column}, '')"
    if not f.accents:
        found = rf"regexp_extract_all({_fold_sql(column)}, '\b[a-z]{{2,}}\b')"
    elif f.pattern == C.WORD_TOKENS:
        found = f"regexp_extract_all(lower({column}), '{_WORD_SQL}')"
    else:
        found = f"regexp_extract_all(lower({column}), '{f.pattern}')"
    return V.kept_sql(found) if f.stop_words else found


def tf_sql(fields, source: str, p: str = "") -> list[str]:
    """``<p>tf``: id, split, label, field, term, tf."""
    ctes = []
    for f in fields:
        ctes.append(f"{p}tok_{f.name} AS (SELECT id, split, label, "
                    f"{_field_tokens_sql(f)} AS t FROM {source})")
    union = " UNION ALL ".join(
        f"SELECT id, split, label, '{f.name}' AS field, "
        f"unnest({_grams_sql('t', f.ngrams == (1, 2))}) AS term FROM {p}tok_{f.name}"
        for f in fields
    )
    ctes.append(f"{p}terms AS ({union})")
    ctes.append(f"{p}tf AS (SELECT id, split, label, field, term, count(*) AS tf FROM {p}terms "
                "GROUP BY ALL)")
    return ctes


def _bound_sql(value, n: str) -> str:
    return str(value) if isinstance(value, int) else f"{value} * {n}"


def vocab_sql(fields, source: str, p: str = "") -> list[str]:
    """``<p>vocab`` of the training rows: field, term, df, tf, idf."""
    n = f"(SELECT count(*) FROM {source} WHERE split = 'train')"
    bounds = " OR ".join(
        f"(field = '{f.name}' AND df >= {_bound_sql(f.min_df, n)} "
        f"AND df <= {_bound_sql(f.max_df, n)})" for f in fields
    )
    limits = " OR ".join(
        f"(field = '{f.name}'" + (f" AND r <= {f.max_features})" if f.max_features else ")")
        for f in fields
    )
    return [
        f"{p}stats AS (SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf "
        f"FROM {p}tf WHERE split = 'train' GROUP BY field, term)",
        f"{p}ranked AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY tf DESC, term) "
        f"AS r FROM {p}stats WHERE {bounds})",
        f"{p}vocab AS (SELECT field, term, df, tf, ln((1.0 + {n}) / (1.0 + df)) + 1 AS idf "
        f"FROM {p}ranked WHERE {limits})",
    ]


def weight_sql(fields, p: str = "", tf: str | None = None) -> list[str]:
    """``<p>w``: id, split, label, field, term, weight, unit length."""
    damped = V.in_sql([f.name for f in fields if f.sublinear] or ["-"])
    return [
        f"{p}w0 AS (SELECT t.id, t.split, t.label, t.field, t.term, "
        f"CASE WHEN t.field IN {damped} THEN 1 + ln(t.tf) ELSE t.tf END * v.idf AS w "
        f"FROM {tf or p + 'tf'} t JOIN {p}vocab v ON v.field = t.field AND v.term = t.term)",
        f"{p}w AS (SELECT id, split, label, field, term, "
        f"w / sqrt(sum(w * w) OVER (PARTITION BY id, field)) AS weight FROM {p}w0)",
    ]


def nb_sql(source: str, p: str = "", alpha: float = C.NB_ALPHA) -> list[str]:
    """``<p>theta`` and ``<p>scored`` (all rows of ``source``)."""
    n = f"(SELECT count(*) FROM {source} WHERE split = 'train'"
    return [
        f"{p}sums AS (SELECT v.term, v.idf, "
        "coalesce(sum(w.weight) FILTER (w.label = 0), 0) AS s0, "
        "coalesce(sum(w.weight) FILTER (w.label = 1), 0) AS s1 "
        f"FROM {p}vocab v LEFT JOIN (SELECT * FROM {p}w WHERE split = 'train') w "
        "ON w.term = v.term GROUP BY v.term, v.idf)",
        f"{p}theta AS (SELECT term, "
        f"ln((s0 + {alpha}) / (SELECT sum(s0) + {alpha} * count(*) FROM {p}sums)) AS theta_0, "
        f"ln((s1 + {alpha}) / (SELECT sum(s1) + {alpha} * count(*) FROM {p}sums)) AS theta_1 "
        f"FROM {p}sums)",
        f"{p}prior AS (SELECT ln({n} AND label = 1) / CAST({n}) AS DOUBLE)) "
        f"- ln({n} AND label = 0) / CAST({n}) AS DOUBLE)) AS bias)",
        f"{p}dots AS (SELECT w.id, sum(w.weight * (t.theta_1 - t.theta_0)) AS dot "
        f"FROM {p}w w JOIN {p}theta t ON t.term = w.term GROUP BY w.id)",
        f"{p}scored AS (SELECT s.id, s.split, s.label, "
        f"coalesce(d.dot, 0) + (SELECT bias FROM {p}prior) AS score, "
        "CASE WHEN coalesce(d.dot, 0) + "
        f"(SELECT bias FROM {p}prior) > 0 THEN 1 ELSE 0 END AS prediction "
        f"FROM {source} s LEFT JOIN {p}dots d ON d.id = s.id)",
    ]


def metric_sql(source: str, by: str = "split", pos: int = 0) -> str:
    hit, miss = f"= {pos}", f"<> {pos}"
    return f"""SELECT {by},
    round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
    round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
  FROM (SELECT {by},
    CAST(count(*) FILTER (label {hit} AND prediction {hit}) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (label {miss} AND prediction {hit}) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (label {hit} AND prediction {miss}) AS DOUBLE) AS fn,
    CAST(count(*) FILTER (label {miss} AND prediction {miss}) AS DOUBLE) AS tn
    FROM {source} GROUP BY {by})"""


_L = [V.ARTICLES, V.LABELLED]
_NB_VOCAB = [*_L, *tf_sql([NB_FIELD], "labelled"), *vocab_sql([NB_FIELD], "labelled")]
_NB = [*_NB_VOCAB, *weight_sql([NB_FIELD]), *nb_sql("labelled")]


# --- Features ----------------------------------------------------------------

@query("vectorizer_tokens", f"""{V.with_sql(V.ARTICLES)} SELECT id,
  array_to_string(regexp_extract_all(lower(content), '{_WORD_SQL}'), ' ') AS words,
  array_to_string({_field_tokens_sql(BIGRAM_FIELD)}, ' ') AS letters FROM articles""")
def vectorizer_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.articles(spark, sf_dir).select(
        "id", text.join_tokens(text.vectorizer_tokens("content")).alias("words"),
        text.join_tokens(BIGRAM_FIELD.tokens()).alias("letters"))


@query("ngrams", f"""{V.with_sql(V.ARTICLES)}, tok AS (SELECT id,
    {_field_tokens_sql(BIGRAM_FIELD)} AS t FROM articles)
  SELECT id, len({_grams_sql('t', True)}) AS n_terms,
    md5(array_to_string({_grams_sql('t', True)}, '|')) AS terms_md5 FROM tok""")
def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = pin(V.articles(spark, sf_dir).select("id", "content"), t=BIGRAM_FIELD.tokens())
    grams = pin(tokens.select("id", "t"), g=text.ngrams("t", 1, 2))
    return grams.select("id", F.size("g").cast("bigint").alias("n_terms"),
                        F.md5(F.array_join("g", "|")).alias("terms_md5"))


def _vocabulary(spark: SparkSession, sf_dir: str, fields) -> DataFrame:
    return features.fit_vocabulary(train_rows(V.labelled(spark, sf_dir)), fields)


@query("tfidf_vocab", V.with_sql(*_NB_VOCAB)
       + "SELECT field, term, df, tf, round(idf, 6) AS idf FROM vocab")
def tfidf_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_vocabulary(spark, sf_dir, [NB_FIELD]))


@query("tfidf_vocab_bigrams", V.with_sql(
    *_L, *tf_sql([BIGRAM_FIELD], "labelled"), *vocab_sql([BIGRAM_FIELD], "labelled"))
    + "SELECT field, term, df, tf, round(idf, 6) AS idf FROM vocab")
def tfidf_vocab_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_vocabulary(spark, sf_dir, [BIGRAM_FIELD]))


@query("tfidf_weights", V.with_sql(*_NB_VOCAB, *weight_sql([NB_FIELD]))
       + "SELECT id, term, round(weight, 6) AS weight FROM w")
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.count_terms(V.labelled(spark, sf_dir), [NB_FIELD], KEEP)
    vocabulary = features.fit_vocabulary(train_rows(rows), [NB_FIELD])
    weights = features.term_weights(rows, vocabulary, [NB_FIELD])
    return weights.select("id", "term", r6("weight").alias("weight"))


@query("tfidf_multi_field", V.with_sql(
    *_L, *tf_sql(BLOCK_FIELDS, "labelled"), *vocab_sql(BLOCK_FIELDS, "labelled"),
    *weight_sql(BLOCK_FIELDS))
    + """SELECT id, field, count(*) AS n_terms, round(sum(weight), 6) AS total,
    round(max(weight), 6) AS largest FROM w GROUP BY id, field""")
def tfidf_multi_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.labelled(spark, sf_dir, columns=META)
    vocabulary = features.fit_vocabulary(train_rows(rows), BLOCK_FIELDS)
    weights = features.term_weights(rows, vocabulary, BLOCK_FIELDS)
    return weights.groupBy("id", "field").agg(
        F.count(F.lit(1)).alias("n_terms"), r6(F.sum("weight")).alias("total"),
        r6(F.max("weight")).alias("largest"))


@query("class_weights", f"""{V.with_sql(V.ARTICLES)}, l AS (SELECT
    CAST({V.strict_sql('type')} AS BIGINT) AS label FROM articles)
  SELECT label, count(*) AS "count", round((SELECT count(label) FROM l) /
    CAST((SELECT count(DISTINCT label) FROM l) * count(*) AS DOUBLE), 6) AS class_weight
  FROM l WHERE label IS NOT NULL GROUP BY label""")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = V.articles(spark, sf_dir).select(labels.map_label_strict("type").alias("label"))
    return rounded(features.class_weights(mapped))


# --- Naive Bayes -------------------------------------------------------------

def naive_bayes_text(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, bayes.BayesModel]:
    rows = features.count_terms(V.labelled(spark, sf_dir), [NB_FIELD], KEEP)
    return rows, bayes.nb_fit(train_rows(rows), [NB_FIELD])


@query("nb_fit", V.with_sql(*_NB) + """SELECT term, round(theta_0, 6) AS theta_0,
  round(theta_1, 6) AS theta_1 FROM theta""")
def nb_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = naive_bayes_text(spark, sf_dir)
    return rounded(model.terms.select("term", "theta_0", "theta_1"))


@query("nb_predict", V.with_sql(*_NB) + """SELECT id, split, CAST(label AS BIGINT) AS label,
  round(score, 6) AS score, CAST(prediction AS BIGINT) AS prediction FROM scored""")
def nb_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = naive_bayes_text(spark, sf_dir)
    return rounded(bayes.nb_predict(rows, model, ["id", "split", "label"]))


@query("nb_metrics", V.with_sql(*_NB) + metric_sql("scored"))
def nb_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = naive_bayes_text(spark, sf_dir)
    scored = bayes.nb_predict(rows, model, ["id", "split", "label"])
    return rounded(evaluation.metrics_by_split(scored))


# The metadata in front of the text.
def _combined_sql(columns) -> str:
    front = " || ".join(f"coalesce({c}, '') || ' '" for c in columns)
    return f"""combined AS (
  SELECT id, split, label, {front} || content AS combined_text FROM labelled)"""


def _nb_meta_sql(columns) -> list[str]:
    return [
        _combined_sql(columns), *tf_sql([META_FIELD], "combined", "m_"),
        *vocab_sql([META_FIELD], "combined", "m_"), *weight_sql([META_FIELD], "m_"),
        *nb_sql("combined", "m_"),
    ]


_NB_META = _nb_meta_sql(C.METADATA_COLUMNS)
_SCORES_SQL = """SELECT id, split, CAST(label AS BIGINT) AS label, round(score, 6) AS score,
  CAST(prediction AS BIGINT) AS prediction FROM m_scored"""


def naive_bayes_meta(rows: DataFrame, columns=C.METADATA_COLUMNS,
                     train_fraction: float = 1.0) -> DataFrame:
    """Scores of all rows by the text-plus-metadata model.

    ``train_fraction`` of the training rows are learnt from; all by default.
    """
    combined = rows.withColumn("combined_text", text.combine_text_and_meta("content", columns)) \
        .select(*KEEP, "combined_text")
    combined = features.count_terms(combined, [META_FIELD], KEEP)
    learnt = train_rows(combined)
    if train_fraction < 1:
        learnt = materialize(random_sample(learnt, train_fraction), "learnt")
    model = bayes.nb_fit(learnt, [META_FIELD])
    return bayes.nb_predict(combined, model, ["id", "split", "label"])


@query("nb_metadata", V.with_sql(*_L, *_NB_META) + _SCORES_SQL)
def nb_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(naive_bayes_meta(V.labelled(spark, sf_dir, columns=META)))


@query("nb_domain", V.with_sql(*_L, *_nb_meta_sql(["domain"])) + _SCORES_SQL)
def nb_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the domain as the only metadata."""
    return rounded(naive_bayes_meta(V.labelled(spark, sf_dir, columns=META), ["domain"]))


@query("model_comparison", V.with_sql(
    *_NB, *_NB_META, f"a AS ({metric_sql('scored')})", f"b AS ({metric_sql('m_scored')})",
    "la AS (UNPIVOT a ON accuracy, precision, recall, f1 INTO NAME metric VALUE baseline)",
    "lb AS (UNPIVOT b ON accuracy, precision, recall, f1 INTO NAME metric VALUE candidate)")
    + """SELECT split, metric, baseline, candidate, round(candidate - baseline, 6) AS delta
    FROM la JOIN lb USING (split, metric)""")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.labelled(spark, sf_dir, columns=META)
    counted = features.count_terms(rows, [NB_FIELD], KEEP)
    model = bayes.nb_fit(train_rows(counted), [NB_FIELD])
    plain = bayes.nb_predict(counted, model, ["id", "split", "label"])
    meta = naive_bayes_meta(rows)
    return rounded(evaluation.compare_models(
        rounded(evaluation.metrics_by_split(plain)), rounded(evaluation.metrics_by_split(meta))))


_FOREIGN = [
    V.CLAIMS, V.CLAIM_ARTICLES,
    f"""foreign_rows AS (SELECT id, 'claims' AS split, content,
      {V.claim_sql('claim_label', C.CLAIM_RELIABLE + C.CLAIM_BORDERLINE)} AS label
      FROM claim_articles WHERE label IS NOT NULL)""",
    *tf_sql([NB_FIELD], "foreign_rows", "f_"),
    "f_vocab AS (SELECT * FROM vocab)",
    *weight_sql([NB_FIELD], "f_"),
    """f_dots AS (SELECT w.id, sum(w.weight * (t.theta_1 - t.theta_0)) AS dot
      FROM f_w w JOIN theta t ON t.term = w.term GROUP BY w.id)""",
    """f_scored AS (SELECT s.id, s.split, s.label, CASE WHEN coalesce(d.dot, 0) +
      (SELECT bias FROM prior) > 0 THEN 1 ELSE 0 END AS prediction
      FROM foreign_rows s LEFT JOIN f_dots d ON d.id = s.id)""",
    """both_scored AS (SELECT split, label, prediction FROM scored
      UNION ALL SELECT split, label, prediction FROM f_scored)""",
]


@query("nb_cross_domain", V.with_sql(*_NB, *_FOREIGN) + metric_sql("both_scored"))
def nb_cross_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on articles; scored on all splits and, unchanged, on statements."""
    rows, model = naive_bayes_text(spark, sf_dir)
    foreign = (
        V.claim_articles(spark, sf_dir)
        .withColumn("label", labels.map_claim_6way("claim_label"))
        .where(F.col("label").isNotNull()).withColumn("split", F.lit("claims"))
    )
    keep = ["id", "split", "label"]
    own = bayes.nb_predict(rows, model, keep)
    scored = own.unionByName(bayes.nb_predict(foreign, model, keep))
    return rounded(evaluation.metrics_by_split(scored))


# --- Evaluation --------------------------------------------------------------

_P = V.with_sql(V.PREDICTIONS)


@query("confusion_matrix", _P + " UNION ALL ".join(
    f"""SELECT split, {pos} AS pos_label,
    count(*) FILTER (label = {pos} AND prediction = {pos}) AS tp,
    count(*) FILTER (label <> {pos} AND prediction = {pos}) AS fp,
    count(*) FILTER (label = {pos} AND prediction <> {pos}) AS fn,
    count(*) FILTER (label <> {pos} AND prediction <> {pos}) AS tn
    FROM predictions GROUP BY split""" for pos in (0, 1)))
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.confusion_matrices(V.predictions(spark, sf_dir), ["split"]))


@query("confusion_table", _P + """SELECT split, CAST(label AS BIGINT) AS label,
  count(*) FILTER (prediction = 0) AS pred_0, count(*) FILTER (prediction = 1) AS pred_1
  FROM predictions GROUP BY split, label""")
def confusion_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.confusion_table(V.predictions(spark, sf_dir), ["split"]))


@query("metrics_by_split", _P + f"""SELECT *, 0 AS pos_label FROM ({metric_sql('predictions')})
  UNION ALL SELECT *, 1 FROM ({metric_sql('predictions', pos=1)})""")
def metrics_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = evaluation.confusion_matrices(V.predictions(spark, sf_dir), ["split"])
    return rounded(evaluation.metrics(both, ["split", "pos_label"]))


@query("classification_report", _P + """, c AS (
    SELECT split, cls, coalesce(tp / nullif(guess, 0), 0) AS p,
      coalesce(tp / nullif(support, 0), 0) AS r, support, tp
    FROM (SELECT split, cls,
        CAST(count(*) FILTER (label = cls AND prediction = cls) AS DOUBLE) AS tp,
        CAST(count(*) FILTER (prediction = cls) AS DOUBLE) AS guess,
        CAST(count(*) FILTER (label = cls) AS DOUBLE) AS support
      FROM predictions, (VALUES (0), (1)) v(cls) GROUP BY split, cls)),
  f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM c)
  SELECT split, CAST(cls AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall,
    round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
  UNION ALL SELECT split, 'accuracy', round(sum(tp) / sum(support), 6),
    round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
    CAST(sum(support) AS BIGINT) FROM f GROUP BY split
  UNION ALL SELECT split, 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
    CAST(sum(support) AS BIGINT) FROM f GROUP BY split
  UNION ALL SELECT split, 'weighted avg', round(sum(p * support) / sum(support), 6),
    round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
    CAST(sum(support) AS BIGINT) FROM f GROUP BY split""")
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.classification_report(V.predictions(spark, sf_dir), ["split"]))


@query("best_candidate", V.with_sql(
    V.PREDICTIONS, "folds AS (SELECT id % 5 AS fold, label, prediction FROM predictions)",
    f"m AS ({metric_sql('folds', 'fold', 1)})")
    + "SELECT fold, f1 FROM m ORDER BY f1 DESC, fold LIMIT 1")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fold of the predictions stands for one candidate."""
    folds = V.predictions(spark, sf_dir).withColumn("fold", F.col("id") % 5)
    scores = evaluation.metrics(
        evaluation.confusion_matrix(folds, ["fold"], pos_label=1), ["fold"])
    return evaluation.best_candidate(rounded(scores), "fold")

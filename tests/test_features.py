"""TF-IDF and the models against brute force."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.operators import bayes, features, linear
from pressmill.operators.features import Field

TEXTS = [
    (1, "train", 0, "red red green blue", "one two"),
    (2, "train", 1, "green green yellow", ""),
    (3, "train", 0, "red blue blue blue black", "two"),
    (4, "train", 1, "yellow white green red", "three two"),
    (5, "val", 1, "green unknown yellow yellow", "two two"),
    (6, "test", 0, "nothing known", None),
    (7, "test", 0, "", ""),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        TEXTS, "id int, split string, label int, body string, title string")


@pytest.fixture(scope="module")
def train(rows):
    return rows.where("split = 'train'")


def grams(text, high=1):
    tokens = [t for t in (text or "").lower().split() if len(t) > 1]
    out = list(tokens)
    if high == 2:
        out += [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]
    return out


def brute_vocabulary(high=1, min_df=1, max_df=None, limit=None):
    df, tf = Counter(), Counter()
    n = 0
    for _, split, _, body, _ in TEXTS:
        if split == "train":
            n += 1
            terms = grams(body, high)
            df.update(set(terms))
            tf.update(terms)
    kept = [t for t in df if df[t] >= min_df and (max_df is None or df[t] <= max_df * n)]
    kept.sort(key=lambda t: (-tf[t], t))
    return {t: math.log((1 + n) / (1 + df[t])) + 1 for t in kept[:limit]}


def brute_weights(idf, body, sublinear, high=1):
    tf = Counter(t for t in grams(body, high) if t in idf)
    w = {t: (1 + math.log(c) if sublinear else c) * idf[t] for t, c in tf.items()}
    norm = math.sqrt(sum(x * x for x in w.values()))
    return {t: x / norm for t, x in w.items()}


@pytest.mark.parametrize("field, options", [
    (Field("f", "body"), {}),
    (Field("f", "body", ngrams=(1, 2), min_df=2), {"high": 2, "min_df": 2}),
    (Field("f", "body", max_df=0.5, max_features=3), {"max_df": 0.5, "limit": 3}),
    (Field("f", "body", ngrams=(1, 2), max_features=5), {"high": 2, "limit": 5}),
])
def test_vocabulary(train, field, options):
    got = {r["term"]: r["idf"] for r in features.fit_vocabulary(train, [field]).collect()}
    assert got == pytest.approx(brute_vocabulary(**options))


@pytest.mark.parametrize("sublinear", [True, False])
def test_weights(rows, train, sublinear):
    field = Field("f", "body", min_df=2, sublinear=sublinear)
    vocabulary = features.fit_vocabulary(train, [field])
    got = {}
    for r in features.term_weights(rows, vocabulary, [field]).collect():
        got.setdefault(r["id"], {})[r["term"]] = r["weight"]
    idf = brute_vocabulary(min_df=2)
    for i, _, _, body, _ in TEXTS:
        expected = brute_weights(idf, body, sublinear)
        assert got.get(i, {}) == pytest.approx(expected)
        if expected:
            assert sum(x * x for x in got[i].values()) == pytest.approx(1)


def test_limits_are_per_field(train):
    fields = [Field("a", "body", max_features=2), Field("b", "title"),
              Field("c", "title", max_features=1)]
    got = Counter(r["field"] for r in features.fit_vocabulary(train, fields).collect())
    assert got == {"a": 2, "b": 3, "c": 1}


def test_index_is_dense_and_sorted(spark):
    words = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("field"),
        F.md5(F.col("id").cast("string")).alias("term"))
    got = features.index_terms(words.repartition(7)).orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(5000))
    pairs = [(r["field"], r["term"]) for r in got]
    assert pairs == sorted(pairs)


def test_class_weights(rows):
    got = {r["label"]: r["class_weight"] for r in features.class_weights(rows).collect()}
    assert got == {0: 7 / (2 * 4), 1: 7 / (2 * 3)}


def test_naive_bayes(rows, train):
    field = Field("f", "body", sublinear=True)
    model = bayes.nb_fit(train, [field])
    idf = brute_vocabulary()
    sums = {0: Counter(), 1: Counter()}
    for _, split, label, body, _ in TEXTS:
        if split == "train":
            for term, w in brute_weights(idf, body, True).items():
                sums[label][term] += w
    theta = {
        c: {t: math.log((sums[c][t] + C.NB_ALPHA)
                        / (sum(sums[c].values()) + C.NB_ALPHA * len(idf))) for t in idf}
        for c in (0, 1)
    }
    got = {r["term"]: (r["theta_0"], r["theta_1"]) for r in model.terms.collect()}
    for term in idf:
        assert got[term] == pytest.approx((theta[0][term], theta[1][term]))
    assert model.priors == pytest.approx((math.log(0.5), math.log(0.5)))
    scores = {r["id"]: (r["score"], r["prediction"])
              for r in bayes.nb_predict(rows, model, ["id"]).collect()}
    assert len(scores) == len(TEXTS)
    for i, _, _, body, _ in TEXTS:
        expected = sum(w * (theta[1][t] - theta[0][t])
                       for t, w in brute_weights(idf, body, True).items())
        assert scores[i][0] == pytest.approx(expected, abs=1e-12)
        assert scores[i][1] == int(expected > 0)


def test_naive_bayes_round_trip(spark, rows, train, tmp_path):
    fields = [Field("f", "body"), Field("t", "title")]
    model = bayes.nb_fit(train, fields)
    model.save(str(tmp_path / "nb"))
    again = bayes.BayesModel.load(spark, str(tmp_path / "nb"), fields)
    one = bayes.nb_predict(rows, model, ["id"]).orderBy("id").collect()
    assert one == bayes.nb_predict(rows, again, ["id"]).orderBy("id").collect()
    assert len(one) == len(TEXTS)


@pytest.fixture(scope="module")
def vectors(rows, train):
    fields = [Field("f", "body", min_df=1), Field("t", "title")]
    vectorizer = linear.fit_vectorizer(train, fields)
    return linear.vectorize(rows, vectorizer, ("id", "split", "label")), vectorizer


def test_vectors(vectors):
    table, vectorizer = vectors
    index = {(r["field"], r["term"]): r["idx"] for r in vectorizer.vocabulary.collect()}
    got = {r["id"]: r["features"] for r in table.collect()}
    assert len(got) == len(TEXTS) and got[7].size == vectorizer.size == len(index)
    assert got[6].numNonzeros() == got[7].numNonzeros() == 0
    idf = brute_vocabulary()
    for term, weight in brute_weights(idf, TEXTS[0][3], False).items():
        assert got[1][index["f", term]] == pytest.approx(weight)


def test_logistic_minimises_the_objective(vectors):
    table, _ = vectors
    fit_on = table.where("split = 'train'")
    model = linear.fit_logistic(fit_on, c=1.0, rows=4, max_iter=200)
    data = fit_on.collect()
    x = np.array([r["features"].toArray() for r in data])
    y = np.array([r["label"] for r in data])
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    # At the optimum the gradient of mean loss + |w|^2 / (2 C n) is zero.
    assert np.allclose(x.T @ (p - y) / 4 + w / 4, 0, atol=1e-4)
    assert abs((p - y).mean()) < 1e-4
    scored = linear.predict_probability(model, fit_on).collect()
    assert [r["prediction"] for r in scored] == [int(r["probability"] >= 0.5) for r in scored]


def test_svm_separates(vectors):
    table, _ = vectors
    fit_on = table.where("split = 'train'")
    guesses = linear.predict(linear.fit_svm(fit_on), fit_on).collect()
    assert all(r["prediction"] == r["label"] for r in guesses)


def test_grid_first_wins_ties(vectors):
    table, _ = vectors
    result = linear.logistic_grid(table.where("split = 'train'"), table.where("split = 'train'"),
                                  grid=(10.0, 100.0, 1000.0), max_iter=50)
    assert {f1 for _, f1 in result.scores} == {1.0} and result.best_c == 10.0


def test_model_round_trip(spark, vectors, train, rows, tmp_path):
    from pyspark.ml.classification import LogisticRegressionModel

    table, vectorizer = vectors
    model = linear.fit_logistic(table.where("split = 'train'"), 1.0, 4)
    model.save(str(tmp_path / "m"))
    vectorizer.save(str(tmp_path / "v"))
    again = linear.Vectorizer.load(spark, str(tmp_path / "v"), vectorizer.fields)
    fresh = linear.vectorize(rows, again, ("id", "label"))
    loaded = LogisticRegressionModel.load(str(tmp_path / "m"))
    assert sorted(linear.predict(loaded, fresh).collect()) == sorted(
        linear.predict(model, table).collect())


def test_oversized_vocabulary_is_refused(train, monkeypatch):
    monkeypatch.setattr(linear, "_MAX_POSITIONS", 2)
    with pytest.raises(ValueError, match="positions"):
        linear.fit_vectorizer(train, [Field("f", "body")])


def test_load_or_fit(spark, train, tmp_path):
    from pyspark.ml.classification import LogisticRegressionModel

    path, fields = str(tmp_path / "v"), [Field("f", "body")]
    first = linear.load_or_fit_vectorizer(train, fields, path)
    again = linear.load_or_fit_vectorizer(train.limit(0), fields, path)
    assert again.size == first.size > 0
    table = linear.vectorize(train, first)
    model_path = str(tmp_path / "m")
    fitted = []

    def fit():
        fitted.append(1)
        return linear.fit_logistic(table, 1.0, 4)

    for _ in range(2):
        model = linear.load_or_fit(lambda: LogisticRegressionModel.load(model_path), fit,
                                   lambda m: m.save(model_path))
    assert len(fitted) == 1 and model.numFeatures == first.size


def test_counted_documents_are_read_as_documents(rows, train):
    fields = [Field("f", "body"), Field("t", "title", ngrams=(1, 2))]
    counted = features.count_terms(rows, fields, ("id", "split", "label"))
    assert "body" not in counted.columns
    for outer in (False, True):
        was, now = [sorted(map(str, features.term_table(df, fields, ("id", "label"), outer).collect()))
                    for df in (rows, counted)]
        assert was == now
    vocabulary = features.fit_vocabulary(train, fields)
    again = features.fit_vocabulary(counted.where("split = 'train'"), fields)
    assert sorted(vocabulary.collect()) == sorted(again.collect())
    one, two = [{(r["id"], r["field"], r["term"]): r["weight"] for r in features.term_weights(
        df, vocabulary, fields).collect()} for df in (rows, counted)]
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k]) for k in one)
    # Another field of the same name is not taken for it.
    assert Field("f", "title").counted not in counted.columns


def test_texts_are_tokenised_once(rows, monkeypatch):
    fields = [Field("f", "body")]
    calls = []
    tokens = Field.tokens
    monkeypatch.setattr(Field, "tokens", lambda self: calls.append(self.name) or tokens(self))
    counted = features.count_terms(rows, fields, ("id", "split", "label"))
    model = bayes.nb_fit(counted.where("split = 'train'"), fields)
    assert bayes.nb_predict(counted, model, ["id"]).count() == len(TEXTS) and calls == ["f"]


def test_counts_in_arrow_batches_equal_a_counter(monkeypatch):
    from pressmill.operators import term_counts

    rng = np.random.default_rng(1)
    lists = [None, [], ["a"], ["a b", "c"], ["a", "b c"],
             *[[f"w{k}" for k in rng.integers(0, 9, n)] + ["é"] for n in rng.integers(0, 30, 40)]]
    monkeypatch.setattr(term_counts, "SLICE_TOKENS", 50)
    for low, high in ((1, 1), (1, 2), (2, 3), (1, 4)):
        found = term_counts._pairs(pa.array(lists, pa.list_(pa.string())), low, high).to_pylist()
        assert len(found) == len(lists)
        for tokens, pairs in zip(lists, found):
            kept = tokens or []
            expected = Counter(" ".join(kept[i:i + n]) for n in range(low, high + 1) for i in range(len(kept) - n + 1))
            assert {p["term"]: p["tf"] for p in pairs} == expected and len(pairs) == len(expected)


def test_vocabulary_sends_a_row_per_slice_and_term(spark):
    from pressmill.operators import term_counts

    rows = spark.range(0, 200, 1, 2).select("id", F.lit("red green blue red").alias("body"))
    tokens = rows.select(Field("f", "body").tokens().alias("f"))
    parts = term_counts.document_counts(tokens, {"f": ("f", 1, 2)}).collect()
    # Before, 6 rows per document went to the aggregate.
    assert len(parts) == 2 * 6 and {r["term"]: (r["df"], r["tf"]) for r in parts}["red"] == (100, 200)


def test_weights_are_grouped_where_they_are_and_joined_by_term_first(spark, rows, train):
    from pressmill.session import with_settings

    fields = [Field("f", "body"), Field("t", "title")]
    vectorizer = linear.fit_vectorizer(train, fields)
    with with_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        found = linear.sparse_rows(rows, vectorizer)
        plan = found._jdf.queryExecution().executedPlan().toString()
        vectors = {r["id"]: r["features"] for r in found.collect()}
    # Documents are placed, both sides of the join, weights by document; before, once more.
    assert plan.count("Exchange hashpartitioning") == 4 and "SortMergeJoin [term#" in plan
    for i, values in ((i, v["values"]) for i, v in vectors.items()):
        known = sum(bool(set(grams(r[k])) & {w["term"] for w in vectorizer.vocabulary.where(f"field = '{n}'").collect()})
                    for r in TEXTS if r[0] == i for k, n in ((3, "f"), (4, "t")))
        assert sum(v * v for v in values) == pytest.approx(known)


def test_scores_are_a_join_with_the_terms(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    def refuse(self):
        raise AssertionError("coefficients on the driver")

    monkeypatch.setattr(linear.TermModel, "coefficients", property(refuse))
    given = [(1, Vectors.sparse(5, {0: 1.0, 3: 2.0})), (1, Vectors.sparse(5, {0: 1.0, 3: 2.0})),
             (0, Vectors.sparse(5, {})), (None, Vectors.dense([0.0, 1.0, 0.0, 0.0, 4.0])), (2, Vectors.sparse(5, {1: 1.0}))]
    vectors = spark.createDataFrame(given, ["label", "features"]).repartition(3)
    w, b = np.array([0.5, 0.0, 0.0, -1.5, 0.25]), 0.125
    terms = spark.createDataFrame([(i, float(x)) for i, x in enumerate(w) if x], "idx int, w double")
    model = linear.TermModel(terms, b, 5)
    expected = sorted((str(label), float(v.toArray() @ w + b)) for label, v in given)
    scored = sorted((str(r["label"]), r["probability"], r["prediction"])
                    for r in linear.predict_probability(model, vectors, ["label"]).collect())
    assert scored == [(i, pytest.approx(1 / (1 + math.exp(-m))), int(m >= 0)) for i, m in sorted(
        expected, key=lambda x: (x[0], 1 / (1 + math.exp(-x[1]))))]
    guesses = sorted((str(r["label"]), r["prediction"]) for r in linear.predict(model, vectors, ["label"]).collect())
    assert guesses == sorted((i, int(m > 0)) for i, m in expected)


def test_formula_models_keep_coefficients_in_a_table(vectors):
    from pressmill.plans import stem_queries

    model = stem_queries._formula_model(vectors[1], logistic=True)
    assert sorted(model.terms.columns) == ["idx", "w"] and model.terms.count() == vectors[1].size == model.numFeatures

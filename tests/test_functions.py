import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.functions import labels, numeric, quality, text


def words(n, distinct=None):
    distinct = distinct or n
    return [f"w{'abcdefghij'[i % 10]}{i % distinct}" for i in range(n)]


def array(values):
    return F.array(*[F.lit(v) for v in values])


def test_clean_text(evaluate):
    raw = "a  b\x1c\r\nc  "
    assert evaluate(v=text.clean_text(F.lit(raw))) == "a b c" == " ".join(raw.split())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\r\x0b\x1c\x1d\x85  　​ab.", max_size=30),
                min_size=1, max_size=20))
def test_clean_text_is_python_split(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(text.clean_text("t")).collect()]
    assert got == [" ".join(t.split()) for t in texts]


def test_tokens(evaluate):
    value = F.lit("It's 3 Cafés, N.B. ABC")
    assert evaluate(v=text.tokenize_alpha(value)) == ["it", "s", "caf", "s", "n", "b", "abc"]
    assert evaluate(v=text.normalize_for_phrase_match(value)) == "it s caf s n b abc"
    assert evaluate(v=text.split_words(F.lit(""))) == []


def test_stop_words_keep_repeats(evaluate):
    assert evaluate(v=text.remove_stopwords(array(["the", "cat", "and", "cat"]))) == ["cat", "cat"]


@pytest.mark.parametrize("value, expected", [
    ("2024-01-02 1/2/24 1-2-2024 Jan 5, 2024 sept 3", 5),
    ("1-2-2024-1-2", 2),
    ("MAY 12 maybe 12 dismay 12", 1),
    ("été2024-01-02 x2024-01-02 2024-01-02é 2024-01-02", 1),
    ("March  3,2020 and sep 31,  1999", 2),
    ("12/31/1999/2 99/99/99", 2),
    ("no dates", 0),
])
def test_dates(evaluate, value, expected):
    assert evaluate(v=text.date_count(F.lit(value))) == expected
    spans = set()
    months = ("jan|january|feb|february|mar|march|apr|april|may|jun|june|jul|july|aug|august|"
              "sep|sept|september|oct|october|nov|november|dec|december")
    for pattern in (r"\b\d{4}-\d{1,2}-\d{1,2}\b", r"\b\d{1,2}/\d{1,2}/\d{2,4}\b",
                    r"\b\d{1,2}-\d{1,2}-\d{2,4}\b",
                    rf"\b(?:{months})\s+\d{{1,2}}(?:,\s*\d{{4}})?\b"):
        spans |= {m.span() for m in re.finditer(pattern, value, re.IGNORECASE)}
    assert len(spans) == expected


@pytest.mark.parametrize("value, expected", [
    ("3.14 1,000 7", 3), ("a1 1a _1 é1 1é", 0), ("12.5.7", 2), ("3.14x 1٢", 2), ("1,000,000", 2),
])
def test_numbers(evaluate, value, expected):
    assert evaluate(v=text.number_count(F.lit(value))) == expected
    assert len(re.findall(r"\b\d+(?:[\.,]\d+)?\b", value)) == expected


def test_urls(evaluate):
    assert evaluate(v=text.url_count(F.lit("see HTTP://a.b/c, WWW.x.y http:// x"))) == 2


def test_statement(evaluate):
    raw = "Says <b>THIS</b>\n\tat HTTP://x.y/z and www.a.b <i\nx> ok"
    assert evaluate(v=text.clean_statement(F.lit(raw))) == "says this at and <i x> ok"
    assert evaluate(v=text.clean_statement(F.lit(None).cast("string"))) == ""


def test_fill_and_combine(evaluate):
    null = F.lit(None).cast("string")
    assert evaluate(v=text.fill_text(null)) == ""
    assert evaluate(v=text.fill_text(F.lit("  a b\n"), trim=True)) == "a b"
    combined = text.combine_text_and_meta(F.lit("body"), [null, F.lit("title"), null])
    assert evaluate(v=combined) == " title  body"


def test_preview_counts_characters(evaluate):
    assert evaluate(v=text.preview(F.lit("é" * 300))) == "é" * 250


def test_ngrams(spark):
    rows = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in rows.select(text.ngrams("t", 1, 2)).collect()]
    assert got == [["a", "b", "c", "a b", "b c"], ["a"], []]


def test_accents_and_letter_tokens(evaluate):
    tokens = text.vectorizer_tokens(F.lit("Ñandú straße naïve a1b xy été"),
                                    C.LETTER_TOKENS, accents=False)
    assert evaluate(v=tokens) == ["nandu", "naive", "xy", "ete"]


def test_word_tokens(evaluate):
    assert evaluate(v=text.vectorizer_tokens(F.lit("A bc d_e 12 é éa"))) == ["bc", "d_e", "12", "éa"]


@pytest.mark.parametrize("tokens, bad", [
    (words(29), True), (words(30), False), (words(1200), False), (words(1201), True),
    # 50 tokens, 14 distinct, the top word 10 times: both bounds met exactly
    (["top"] * 10 + [f"x{i % 13}" for i in range(40)], False),
    (["top"] * 11 + [f"x{i % 13}" for i in range(39)], True),
    (["top"] * 10 + [f"x{i % 12}" for i in range(40)], True),
])
def test_token_quality(spark, tokens, bad):
    rows = spark.createDataFrame([(tokens,)], "t array<string>")
    assert rows.select(quality.fails_token_quality("t")).first()[0] is bad


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefg"), min_size=1, max_size=40),
                min_size=1, max_size=20),
       st.sampled_from([0.2, 0.28, 0.3, 0.5, 1 / 3, 1.0]))
def test_top_word_tests_agree(spark, lists, ratio):
    rows = spark.createDataFrame([(t,) for t in lists], "t array<string>")
    got = rows.select(quality.top_word_ratio("t"), quality.top_word_exceeds("t", ratio)).collect()
    for tokens, (share, exceeds) in zip(lists, got):
        expected = max(tokens.count(w) for w in tokens) / len(tokens)
        assert share == expected and exceeds == (expected > ratio)


def test_phrases(evaluate):
    norm = text.normalize_for_phrase_match(F.lit("Please SUBSCRIBE now"))
    assert evaluate(v=quality.has_phrase(norm)) is True
    assert evaluate(v=quality.has_phrase(F.lit("nothing here"))) is False


def test_labels(spark):
    rows = spark.createDataFrame([(" Fake ",), ("fake",), ("reliable",), ("bias",), (None,)],
                                 "t string")
    strict = [r[0] for r in rows.select(labels.map_label_strict("t")).collect()]
    loose = [r[0] for r in rows.select(labels.map_label_normalized("t")).collect()]
    assert strict == [None, 0, 1, None, None]
    assert loose == [1, 1, 0, None, None]


def test_claim_labels(spark):
    rows = spark.createDataFrame([("half-true",), (" False ",), ("true",), ("barely-true",)],
                                 "t string")
    assert [r[0] for r in rows.select(labels.map_claim_5way("t")).collect()] == [None, 0, 1, 0]
    assert [r[0] for r in rows.select(labels.map_claim_6way("t")).collect()] == [1, None, 1, 0]


def test_safe_divide(evaluate):
    assert evaluate(v=numeric.safe_divide(F.lit(1), F.lit(0))) == 0.0
    assert evaluate(v=numeric.reduction_percent(F.lit(8), F.lit(6))) == 25.0


def test_accents_of_any_script(evaluate):
    text_in = "oﬃce ＡＢＣ café ẛ̣ ① ㎡ \U0001d400 İώ ½"
    import unicodedata

    plain = "".join(c for c in unicodedata.normalize("NFKD", text_in) if not unicodedata.combining(c))
    assert evaluate(x=text.strip_accents(F.lit(text_in))) == plain
    assert evaluate(x=text.vectorizer_tokens(F.lit("oﬃce ＡＢＣ café"), "[a-z]{2,}", accents=False)) \
        == ["office", "abc", "cafe"]


def test_counts_skip_places_where_no_match_can_start(spark):
    """The classes in front of the patterns change no count, and every pattern of a count has one."""
    space, digit, after, before = C.SPACE, r"\p{Nd}", r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
    month = "|".join(C.MONTH_NAMES)
    plain = {
        C.URL_PATTERN: rf"(?iU)https?://{C.NOT_SPACE}+|www\.{C.NOT_SPACE}+",
        C.DATE_PATTERNS[0]: rf"{after}{digit}{{4}}-{digit}{{1,2}}-{digit}{{1,2}}{before}",
        C.DATE_PATTERNS[1]: rf"{after}{digit}{{1,2}}/{digit}{{1,2}}/{digit}{{2,4}}{before}",
        C.DATE_PATTERNS[2]: rf"{after}{digit}{{1,2}}-{digit}{{1,2}}-{digit}{{2,4}}{before}",
        C.DATE_PATTERNS[3]: rf"(?U){after}(?i:{month}){space}+{digit}{{1,2}}(?:,{space}*{digit}{{4}})?{before}",
        C.NUMBER_PATTERN: rf"{after}{digit}+(?:[.,]{digit}+)?{before}",
    }
    dates = [f"{form} 1{tail}" for name in C.MONTH_NAMES for form in (name, name.upper(), name.title(), "x" + name)
             for tail in ("", ", 2020", "2, 2021", "a")]
    texts = [*dates, "ſept 3 auɡ 4 ſEP\x1c5", "2020-1-2 1/2/20 1-2-2020 x1-2-20 ٣٤٥٦-١-٢ 1.5 2,5 3. 4a b5 _6",
             "http://a HTTPS://b httpſ://c www.d xwww.e WWW.  hhttp://f w h ww.g", "", "\U0001D7D8 ² ½ 12"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for fast, slow in plain.items():
        assert re.match(r"(\(\?U\))?\(\?=", fast)
        rows = frame.select("t", F.regexp_count("t", F.lit(fast)).alias("a"), F.regexp_count("t", F.lit(slow)).alias("b")).collect()
        assert [r for r in rows if r.a != r.b] == [] and any(r.a for r in rows)

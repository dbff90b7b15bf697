"""Porter stemming (M. F. Porter, "An algorithm for suffix stripping", 1980).

The stem of a word is a pure function of the word, so the text-level operator is
map-only: no shuffle, one Arrow batch in and out, each distinct word stemmed
once per Python worker thanks to a memo. Word tables are stemmed after they have
been aggregated, that is once per distinct word.

``extended=True`` adds the departures from the paper that the common Python
implementation makes by default (irregular forms, two-letter words left alone,
``y`` kept after a vowel, a few more suffixes); ``extended=False`` is the paper.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The stemmer travels with the job, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MEMO_WORDS = 50_000
#: Of texts that are Python strings at a time, about.
_PART_BYTES = 1 << 20

# Consonant and vowel runs: y is a vowel after a consonant.
_CONS, _VOWEL = "[^aeiou]", "[aeiouy]"
_CONS_RUN, _VOWEL_RUN = f"{_CONS}[^aeiouy]*", f"{_VOWEL}[aeiou]*"
_M_GT_0 = re.compile(f"^(?:{_CONS_RUN})?{_VOWEL_RUN}{_CONS_RUN}")
_M_EQ_1 = re.compile(f"^(?:{_CONS_RUN})?{_VOWEL_RUN}{_CONS_RUN}(?:{_VOWEL_RUN})?$")
_M_GT_1 = re.compile(f"^(?:{_CONS_RUN})?(?:{_VOWEL_RUN}{_CONS_RUN}){{2}}")
_HAS_VOWEL = re.compile(f"^(?:{_CONS_RUN})?{_VOWEL}")
_DOUBLE_CONS = re.compile(r"([^aeiouy])\1$|(?<=[^aeiouy])yy$")
_ENDS_CVC = re.compile("(?:^y|[aeiou]y|[^aeiouy])[aeiouy][^aeiouwxy]$")
_VC_ONLY = re.compile("^[aeiou][^aeiou]$")

# Suffix tables of the paper, (suffix, replacement).
_STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
_STEP_2_EXTENDED = tuple(
    ("bli", "ble") if rule[0] == "abli" else rule for rule in _STEP_2
) + (("fulli", "ful"),)
_STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)
_STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)
# Irregular forms of the extended variant.
_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning",
    "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


def _ends_cvc(stem: str, extended: bool) -> bool:
    return bool(_ENDS_CVC.search(stem)) or (extended and bool(_VC_ONLY.match(stem)))


def _plural(word: str, extended: bool) -> str:
    if extended and len(word) == 4 and word.endswith("ies"):
        return word[:-1]
    if word.endswith(("sses", "ies")):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past_and_gerund(word: str, extended: bool) -> str:
    if extended and word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _M_GT_0.match(word[:-3]) else word
    for suffix in ("ed", "ing"):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            if _HAS_VOWEL.match(stem):
                break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _DOUBLE_CONS.search(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    if _M_EQ_1.match(stem) and _ends_cvc(stem, extended):
        return stem + "e"
    return stem


def _final_y(word: str, extended: bool) -> str:
    if not word.endswith("y"):
        return word
    stem = word[:-1]
    if extended:
        # The letter before is a consonant and not the first letter of the word.
        ok = len(stem) > 1 and bool(re.search(r"[^aeiouy]$|[aeiou]y$", stem))
    else:
        ok = bool(_HAS_VOWEL.match(stem))
    return stem + "i" if ok else word


def _replace_longest(word: str, rules: tuple[tuple[str, str], ...]) -> str:
    hits = [rule for rule in rules if word.endswith(rule[0])]
    if not hits:
        return word
    suffix, replacement = max(hits, key=lambda rule: len(rule[0]))
    stem = word[: -len(suffix)]
    return stem + replacement if _M_GT_0.match(stem) else word


def _derivation(word: str, extended: bool) -> str:
    if not extended:
        return _replace_longest(word, _STEP_2)
    if word.endswith("alli"):
        # The shortened word is tried again: "radically" -> "radic".
        return _derivation(word[:-2], extended) if _M_GT_0.match(word[:-4]) else word
    if word.endswith("logi"):
        return word[:-1] if _M_GT_0.match(word[:-3]) else word
    return _replace_longest(word, _STEP_2_EXTENDED)


def _strip_suffix(word: str) -> str:
    hits = [suffix for suffix in _STEP_4 if word.endswith(suffix)]
    if not hits:
        return word
    suffix = max(hits, key=len)
    stem = word[: -len(suffix)]
    if suffix == "ion" and not stem.endswith(("s", "t")):
        return word
    return stem if _M_GT_1.match(stem) else word


def _tidy(word: str, extended: bool) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _M_GT_1.match(stem) or (_M_EQ_1.match(stem) and not _ends_cvc(stem, extended)):
            word = stem
    if word.endswith("ll") and _M_GT_1.match(word[:-1]):
        word = word[:-1]
    return word


def porter_stem(word: str, extended: bool = True) -> str:
    """Stem of one lower-case word."""
    if extended and word in _IRREGULAR:
        return _IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _plural(word, extended)
    word = _past_and_gerund(word, extended)
    word = _final_y(word, extended)
    word = _derivation(word, extended)
    word = _replace_longest(word, _STEP_3)
    word = _strip_suffix(word)
    return _tidy(word, extended)


def _parts(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of some rows, fewer where texts are long."""
    rows = max(1, len(texts) * _PART_BYTES // max(texts.nbytes, 1))
    for at in range(0, len(texts), rows):
        yield texts.slice(at, rows)


@lru_cache(maxsize=None)
def _stem_udf(extended: bool):
    @F.arrow_udf("string")
    def stem_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # One memo per task; bounded, so a huge vocabulary cannot fill the worker.
        stem = lru_cache(maxsize=_MEMO_WORDS)(lambda w: porter_stem(w, extended))
        for texts in batches:
            # Only the texts of a slice are Python strings at a time.
            yield pa.concat_arrays([pa.array(
                [None if t is None else " ".join(map(stem, t.split(" "))) for t in part.to_pylist()], pa.string())
                for part in _parts(texts)] or [pa.array([], pa.string())])

    return stem_texts


def stem_text(joined: Column | str, extended: bool = True) -> Column:
    """Stems of a space-joined token string, order and length kept.

    A word column is the special case of one token per row.
    """
    return _stem_udf(extended)(F.col(joined) if isinstance(joined, str) else joined)


def stem_tokens(df: DataFrame, tokens: str, output: str = "stems",
                extended: bool = True) -> DataFrame:
    """Add ``output``: the stem of every token, as an array."""
    joined = stem_text(F.array_join(F.col(tokens), " "), extended)
    return df.withColumn(output, joined).withColumn(
        output,
        F.when(F.col(output) == "", F.array().cast("array<string>"))
        .otherwise(F.split(output, " ")),
    )

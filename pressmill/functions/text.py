"""Text expressions. Each takes and returns a ``Column`` and stays in the JVM."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Sequence
from functools import cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill import constants as C


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text: Column | str) -> Column:
    """Collapse every run of whitespace, line breaks included, to one space; trim.

    NULL stays NULL; use ``fill_text`` where the empty string is wanted.
    """
    return F.trim(F.regexp_replace(_col(text), C.SPACES_PATTERN, " "))


def letters_only(text: Column | str) -> Column:
    """Lower-cased runs of a-z joined by single spaces.

    This is both the text on which phrases are matched and, split on the space,
    the list of alphabetic tokens; one regex pass serves the two.
    """
    return F.trim(F.regexp_replace(F.lower(_col(text)), C.NON_LETTERS, " "))


normalize_for_phrase_match = letters_only


def split_words(joined: Column | str) -> Column:
    """Words of a space-joined string; the empty string has none.

    ``joined`` should be a plain column: it is read twice.
    """
    joined = _col(joined)
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, " "))


def tokenize_alpha(text: Column | str) -> Column:
    """All runs of a-z in the lower-cased text."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit("[a-z]+"), F.lit(0))


def remove_stopwords(tokens: Column | str, stop_words: Iterable[str] = C.STOP_WORDS) -> Column:
    """Keep order and repeats, drop the listed words."""
    listed = list(stop_words)
    return F.filter(_col(tokens), lambda t: ~t.isin(listed))


def join_tokens(tokens: Column | str) -> Column:
    return F.array_join(_col(tokens), " ")


def url_count(text: Column | str) -> Column:
    return F.regexp_count(_col(text), F.lit(C.URL_PATTERN))


def date_count(text: Column | str) -> Column:
    """Number of distinct spans that match one of four date patterns.

    No span can match two of them, so the counts add up. The patterns are not
    merged into one, because overlapping hits of different patterns all count.
    """
    counts = [F.regexp_count(_col(text), F.lit(p)) for p in C.DATE_PATTERNS]
    total = counts[0]
    for other in counts[1:]:
        total = total + other
    return total


def number_count(text: Column | str) -> Column:
    return F.regexp_count(_col(text), F.lit(C.NUMBER_PATTERN))


def token_count(tokens: Column | str) -> Column:
    return F.size(_col(tokens))


def content_hash(text: Column | str) -> Column:
    """MD5 hex digest of the UTF-8 bytes."""
    return F.md5(_col(text))


def preview(text: Column | str, chars: int = C.PREVIEW_CHARS) -> Column:
    return F.substring(_col(text), 1, chars)


def clean_statement(text: Column | str) -> Column:
    """Lower-case, strip URLs and tags, collapse whitespace."""
    no_urls = F.regexp_replace(F.lower(_col(text)), C.MARKUP_URL_PATTERN, " ")
    no_tags = F.regexp_replace(no_urls, C.MARKUP_TAG_PATTERN, " ")
    return F.coalesce(clean_text(no_tags), F.lit(""))


def fill_text(column: Column | str, trim: bool = False) -> Column:
    """NULL becomes the empty string; optionally strip surrounding whitespace."""
    filled = F.coalesce(_col(column).cast("string"), F.lit(""))
    if not trim:
        return filled
    return F.regexp_replace(filled, C.EDGE_SPACES_PATTERN, "")


def combine_text_and_meta(text: Column | str,
                          metadata: Sequence[Column | str] = C.METADATA_COLUMNS) -> Column:
    """Metadata first, then the text, single spaces between, NULL as ''."""
    pieces: list[Column] = []
    for part in (*metadata, text):
        pieces += [fill_text(part), F.lit(" ")]
    return F.concat(*pieces[:-1])


@cache
def _accent_table() -> tuple[str, str, dict[str, str]]:
    """Characters with a one-character compatibility base and combining marks, and others.

    Built from Unicode normalisation over all code points; the marks come last, so
    that ``translate`` deletes them. The dictionary has the characters whose base is
    longer (ligatures, fractions, units) or empty. Hangul syllables stay whole: their
    parts are letters of the same script.
    """
    accented, base, marks, longer = [], [], [], {}
    for point in chain(range(0x80, 0xAC00), range(0xD7A4, 0xD800), range(0xE000, sys.maxunicode + 1)):
        char = chr(point)
        if unicodedata.combining(char):
            marks.append(char)
            continue
        plain = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if len(plain) == 1 and plain != char:
            accented.append(char)
            base.append(plain)
        elif plain != char:
            longer[char] = plain
    return "".join(accented + marks), "".join(base), longer


def strip_accents(text: Column | str) -> Column:
    """Compatibility form without combining marks, as Unicode normalisation (NFKD) has it."""
    accented, base, longer = _accent_table()
    text = _col(text)
    # Pair and key marks are no characters of any text that has been decoded.
    table = F.str_to_map(F.lit("\ufdd0".join(f"{k}\ufdd1{v}" for k, v in longer.items())),
                         F.lit("\ufdd0"), F.lit("\ufdd1"))
    spelled = F.array_join(F.transform(
        F.split(text, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    # Spelling out looks up every character as a string; only texts that need it come there.
    several = F.translate(text, "".join(longer), "") != text
    whole = F.when(several, spelled).otherwise(text)
    return F.when(text.rlike(r"[^\x00-\x7f]"), F.translate(whole, accented, base)).otherwise(text)


def vectorizer_tokens(text: Column | str, pattern: str = C.WORD_TOKENS,
                      accents: bool = True, stop_words: Iterable[str] = ()) -> Column:
    """Tokens the way a TF-IDF vectoriser takes them.

    ``accents=False`` strips diacritics first. Stop words go before n-grams are
    built, so an n-gram may join words that a stop word separated.
    """
    lowered = F.lower(fill_text(text))
    if not accents:
        lowered = strip_accents(lowered)
    tokens = F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))
    listed = list(stop_words)
    return remove_stopwords(tokens, listed) if listed else tokens


def ngrams(tokens: Column | str, low: int = 1, high: int = 1) -> Column:
    """All n-grams of ``low`` to ``high`` tokens, shorter ones first.

    ``tokens`` should be a plain column: it is read once per n.
    """
    tokens = _col(tokens)
    if (low, high) == (1, 1):
        return tokens
    blocks = [tokens if n == 1 else _grams(tokens, n) for n in range(low, high + 1)]
    return F.concat(*blocks) if len(blocks) > 1 else blocks[0]


def _grams(tokens: Column, n: int) -> Column:
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1)))

    def gram(start: Column) -> Column:
        parts = [F.get(tokens, start - 1)]
        for offset in range(n - 1):
            parts += [F.lit(" "), F.get(tokens, start + offset)]
        return F.concat(*parts)

    grams = F.transform(starts, lambda start: gram(start))
    return F.coalesce(grams, F.array().cast("array<string>"))

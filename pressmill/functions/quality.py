"""Quality predicates over text and token columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill import constants as C


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_phrase(text: Column | str, phrases: Sequence[str] = C.RAW_BOILERPLATE) -> Column:
    """Any phrase occurs as a substring, word boundaries ignored."""
    text = _col(text)
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | F.contains(text, F.lit(phrase))
    return hit


def distinct_ratio(tokens: Column | str) -> Column:
    tokens = _col(tokens)
    return F.size(F.array_distinct(tokens)).cast("double") / F.nullif(F.size(tokens), F.lit(0))


def top_word_count(tokens: Column | str) -> Column:
    """Occurrences of the most frequent token: the longest run once sorted."""
    start = F.struct(
        F.lit(None).cast("string").alias("word"), F.lit(0).alias("run"), F.lit(0).alias("best")
    )

    def step(acc: Column, word: Column) -> Column:
        run = F.when(word == acc["word"], acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(word.alias("word"), run.alias("run"),
                        F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(F.sort_array(_col(tokens)), start, step, lambda acc: acc["best"])


def top_word_ratio(tokens: Column | str) -> Column:
    tokens = _col(tokens)
    return top_word_count(tokens).cast("double") / F.nullif(F.size(tokens), F.lit(0))


def top_word_exceeds(tokens: Column | str, ratio: float) -> Column:
    """``top_word_ratio(tokens) > ratio`` without counting every word.

    With ``k`` the smallest count above the bound, some word reaches it exactly
    if two places ``k - 1`` apart in the sorted tokens hold the same word.
    """
    tokens = _col(tokens)
    size = F.size(tokens)
    floor = F.floor(size * F.lit(ratio)).cast("int")

    def within(count: Column) -> Column:
        return (count.cast("double") / F.nullif(size, F.lit(0)) <= ratio).cast("int")

    k = floor + within(floor) + within(floor + 1)
    # One-element transforms bind a value to a name, so it is computed once.
    bound = F.transform(F.array(F.struct(F.sort_array(tokens).alias("s"), k.alias("k"))), lambda b: (
        F.when(size < b["k"], F.lit(False)).otherwise(F.exists(
            F.sequence(F.lit(0), size - b["k"]),
            lambda i: F.get(b["s"], i) == F.get(b["s"], i + b["k"] - 1),
        ))
    ))
    return F.get(bound, F.lit(0))


def fails_token_quality(tokens: Column | str, min_tokens: int = C.MIN_TOKENS,
                        max_tokens: int = C.MAX_TOKENS,
                        min_distinct_ratio: float = C.MIN_DISTINCT_RATIO,
                        max_top_ratio: float = C.MAX_TOP_WORD_RATIO) -> Column:
    """Too short, too long, too repetitive, or dominated by one word.

    The length tests come first, so the sorting ones only see bounded arrays.
    """
    tokens = _col(tokens)
    size = F.size(tokens)
    return (
        F.when((size < min_tokens) | (size > max_tokens), F.lit(True))
        .when(distinct_ratio(tokens) < min_distinct_ratio, F.lit(True))
        .when(top_word_exceeds(tokens, max_top_ratio), F.lit(True))
        .otherwise(F.lit(False))
    )

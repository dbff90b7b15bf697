"""Raw articles to processed, stemmed articles, and the vocabulary totals."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill import constants as C
from pressmill.functions import quality, text
from pressmill.functions.numeric import reduction_percent
from pressmill.functions.pinning import pin
from pressmill.operators.stemming import stem_text


def drop_null_text(df: DataFrame, content: str = "content") -> DataFrame:
    return df.where(F.col(content).isNotNull())


def with_tokens(df: DataFrame, content: str = "content",
                stop_words: Iterable[str] = C.STOP_WORDS) -> DataFrame:
    """Add ``tokens`` and ``kept`` (stop words gone); drop rows left empty.

    Collapsing whitespace cannot change the runs of letters, so the raw text is
    tokenised directly.
    """
    tokenized = pin(drop_null_text(df, content), tokens=text.tokenize_alpha(content))
    return pin(tokenized, kept=text.remove_stopwords("tokens", stop_words)).where(
        F.size("kept") > 0
    )


def clean_articles(df: DataFrame, content: str = "content",
                   stop_words: Iterable[str] = C.STOP_WORDS,
                   keep: Sequence[str] = ("id", "type")) -> DataFrame:
    """Articles that pass every quality test, with their tokens and stems.

    Columns: ``keep``, ``tokens``, ``kept`` and ``processed_text``. The tests
    that need no stems run first, so rejected texts never reach Python; since a
    row is dropped when any test fails, the order does not change the result.
    The plan has no shuffle.
    """
    cheap = (
        pin(with_tokens(df.select(*keep, content), content, stop_words),
            joined=text.join_tokens("tokens"))
        .where(~quality.has_phrase("joined"))
        .where(~quality.fails_token_quality("kept"))
        .select(*keep, "tokens", "kept", text.join_tokens("kept").alias("joined"))
    )
    stemmed = pin(cheap, processed_text=stem_text("joined")).drop("joined")
    return stemmed.where(~quality.has_phrase("processed_text", C.STEMMED_BOILERPLATE))


def processed_articles(df: DataFrame, content: str = "content",
                       stop_words: Iterable[str] = C.STOP_WORDS) -> DataFrame:
    """The table the later stages read: ``id, type, processed_text``."""
    return clean_articles(df, content, stop_words).select("id", "type", "processed_text")


def quality_report(df: DataFrame, content: str = "content",
                   stop_words: Iterable[str] = C.STOP_WORDS) -> DataFrame:
    """Per article the verdict and its first reason, in the order of the tests.

    Reasons: ``boilerplate``, ``tokens``, ``stemmed_boilerplate`` or NULL.
    """
    tested = pin(
        with_tokens(df.select("id", content), content, stop_words)
        .withColumn("joined", text.join_tokens("tokens")),
        boilerplate=quality.has_phrase("joined"), bad_tokens=quality.fails_token_quality("kept"),
    )
    # Only texts that pass the cheap tests go to the stemmer.
    passed = F.when(~F.col("boilerplate") & ~F.col("bad_tokens"), text.join_tokens("kept"))
    flagged = pin(tested.select("id", "boilerplate", "bad_tokens", passed.alias("joined")),
                  stemmed=stem_text("joined"))
    reason = (
        F.when(F.col("boilerplate"), "boilerplate")
        .when(F.col("bad_tokens"), "tokens")
        .when(quality.has_phrase("stemmed", C.STEMMED_BOILERPLATE), "stemmed_boilerplate")
    )
    return flagged.select("id", reason.alias("drop_reason")).withColumn(
        "low_quality", F.col("drop_reason").isNotNull()
    )


def judged_articles(df: DataFrame, content: str = "content",
                    stop_words: Iterable[str] = C.STOP_WORDS,
                    keep: Sequence[str] = ("id", "type")) -> DataFrame:
    """Every article with its ``outcome``, and, if it is kept, ``tokens`` and ``processed_text``.

    Outcomes: ``null_text``, ``no_words``, the reasons of ``quality_report``, or ``kept``.
    """
    tokenized = pin(df.select(*keep, content), tokens=text.tokenize_alpha(content))
    split = pin(tokenized.select(*keep, "tokens"), kept=text.remove_stopwords("tokens", stop_words))
    first = F.when(F.col("tokens").isNull(), "null_text").when(F.size("kept") == 0, "no_words") \
        .when(quality.has_phrase(text.join_tokens("tokens")), "boilerplate") \
        .when(quality.fails_token_quality("kept"), "tokens")
    tested = pin(split, first=first)
    passed = F.when(F.col("first").isNull(), text.join_tokens("kept"))
    stemmed = pin(tested.select(*keep, "tokens", "first", passed.alias("joined")), stemmed=stem_text("joined"))
    outcome = F.coalesce("first", F.when(quality.has_phrase("stemmed", C.STEMMED_BOILERPLATE), "stemmed_boilerplate"),
                         F.lit("kept"))
    done = pin(stemmed, outcome=outcome)
    stays = F.col("outcome") == "kept"
    return done.select(*keep, "outcome", F.when(stays, F.col("tokens")).alias("tokens"),
                       F.when(stays, F.col("stemmed")).alias("processed_text"))


def word_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Frequency of every word. Frequent words combine on the map side.

    The words are pinned: exploding them would have the optimiser test them first
    and so make them from the text again for each test.
    """
    words = pin(df.select(tokens), _words=F.col(tokens))
    return words.select(F.explode("_words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("count")
    )


def drop_stopword_rows(counts: DataFrame,
                       stop_words: Iterable[str] = C.STOP_WORDS) -> DataFrame:
    return counts.where(~F.col("word").isin(list(stop_words)))


def stemmed_word_counts(counts: DataFrame,
                        stop_words: Iterable[str] = C.STOP_WORDS) -> DataFrame:
    """Stem frequencies from word frequencies: each distinct word stemmed once."""
    return (
        drop_stopword_rows(counts, stop_words)
        .select(stem_text("word").alias("word"), "count")
        .groupBy("word").agg(F.sum("count").alias("count"))
    )


def sample_rows_with_stems(features: DataFrame,
                           stop_words: Iterable[str] = C.STOP_WORDS,
                           k: int = C.SAMPLE_ROWS) -> DataFrame:
    """The first analysed articles with their features and stemmed text.

    ``features`` must carry ``tokens``; only the chosen rows are stemmed.
    """
    chosen = features.orderBy("id").limit(k)
    kept = text.join_tokens(text.remove_stopwords("tokens", stop_words))
    return chosen.withColumn("processed_text", stem_text(kept)).drop("tokens")


def vocabulary_sizes(clean: DataFrame, stop_words: Iterable[str] = C.STOP_WORDS,
                     stems: bool = True) -> DataFrame:
    """Distinct words and total tokens before and after stop words and stemming.

    All totals come from one table of word counts, that is one shuffle of
    already combined counts.
    """
    return vocabulary_sizes_of(word_counts(clean), stop_words, stems)


def vocabulary_sizes_of(counts: DataFrame, stop_words: Iterable[str] = C.STOP_WORDS,
                        stems: bool = True) -> DataFrame:
    """The same from a table of word counts."""
    kept = ~F.col("word").isin(list(stop_words))
    totals = [
        F.count(F.lit(1)).alias("vocab_raw"),
        F.count_if(kept).alias("vocab_no_stop"),
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("tokens_raw"),
        F.coalesce(F.sum(F.when(kept, F.col("count"))), F.lit(0)).cast("bigint")
        .alias("tokens_no_stop"),
    ]
    if not stems:
        return counts.agg(*totals)
    stemmed = counts.withColumn("stem", F.when(kept, stem_text("word")))
    per_stem = stemmed.groupBy("stem").agg(
        F.count(F.lit(1)).alias("words"), F.sum("count").alias("tokens")
    )
    # The NULL group holds the stop words.
    real = F.col("stem").isNotNull()

    def total(value: Column, alias: str) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(alias)

    return per_stem.agg(
        total(F.col("words"), "vocab_raw"),
        total(F.when(real, F.col("words")), "vocab_no_stop"),
        F.count_if(real).alias("vocab_stemmed"),
        total(F.col("tokens"), "tokens_raw"),
        total(F.when(real, F.col("tokens")), "tokens_no_stop"),
        total(F.when(real, F.col("tokens")), "tokens_stemmed"),
    )


def vocabulary_reduction(sizes: DataFrame) -> DataFrame:
    """Percent of the vocabulary removed by stop words and by stemming."""
    return sizes.select(
        reduction_percent(F.col("vocab_raw"), F.col("vocab_no_stop"))
        .alias("stopword_reduction"),
        reduction_percent(F.col("vocab_no_stop"), F.col("vocab_stemmed"))
        .alias("stemming_reduction"),
    )


def vocabulary_union(*vocabularies: DataFrame) -> DataFrame:
    """Distinct words of several vocabularies, for totals kept across batches."""
    merged = vocabularies[0].select("word")
    for other in vocabularies[1:]:
        merged = merged.unionByName(other.select("word"))
    return merged.distinct()

"""TF-IDF as long tables: one row per document, field and term.

The within-document term counts are taken in Arrow batches (``term_counts``), so counting
needs no shuffle. The vocabulary is one aggregate by term, of counts that are already added
up over some documents. Only unit-length weights need a document's rows together;
there the documents are moved before they are exploded, which is several times
less data than moving their terms.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressmill import constants as C
from pressmill.functions import text
from pressmill.functions.pinning import pin
from pressmill.operators.term_counts import PAIRS, document_counts, pairs_of
from pressmill.session import materialize


@dataclass(frozen=True)
class Field:
    """One block of features.

    ``min_df`` and ``max_df`` are document counts if ``int`` and shares of the
    documents if ``float``.
    """

    name: str
    column: str
    pattern: str = C.WORD_TOKENS
    accents: bool = True
    stop_words: tuple[str, ...] = ()
    ngrams: tuple[int, int] = (1, 1)
    min_df: int | float = 1
    max_df: int | float = 1.0
    max_features: int | None = None
    sublinear: bool = False

    @property
    def counted(self) -> str:
        """The column of its counted terms, named by all that they depend on."""
        settings = (self.column, self.pattern, self.accents, self.stop_words, self.ngrams)
        return f"_terms_{self.name}_{hashlib.md5(repr(settings).encode()).hexdigest()[:12]}"

    def tokens(self) -> Column:
        return text.vectorizer_tokens(self.column, self.pattern, self.accents, self.stop_words)


# --- Fixed values: the feature settings of the baselines ---------------------
NB_TEXT = Field("text", "processed_text", max_features=100_000, sublinear=True)
NB_COMBINED = Field("text", "combined_text", max_features=10_000, sublinear=True,
                    min_df=5, max_df=0.95)
SVM_TEXT = Field("text", "processed_text", pattern=C.LETTER_TOKENS, accents=False,
                 stop_words=C.STOP_WORDS, ngrams=(1, 2), min_df=5, max_df=0.9,
                 max_features=150_000, sublinear=True)
SVM_TITLE = replace(SVM_TEXT, name="title", column="title", min_df=3, max_features=30_000)
LOGISTIC_TEXT = Field("text", "processed_text", stop_words=C.STOP_WORDS, ngrams=(1, 2),
                      min_df=2, max_df=0.95)
LOGISTIC_DOMAIN = Field("domain", "domain")
LOGISTIC_TITLE = replace(LOGISTIC_TEXT, name="title", column="title")
LOGISTIC_AUTHORS = replace(LOGISTIC_TEXT, name="authors", column="authors")
LOGISTIC_FIELDS = (LOGISTIC_TEXT, LOGISTIC_DOMAIN, LOGISTIC_TITLE, LOGISTIC_AUTHORS)


def term_table(df: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ("id",),
               outer: bool = False) -> DataFrame:
    """``keep..., field, term, tf``: how often each term occurs in each document.

    ``outer=True`` gives every document and field one more row, whose term is
    NULL, so that documents without known terms survive a join. Documents may come
    from ``count_terms``.
    """
    counted = _counted_rows(df, fields, keep)
    pairs = F.col("pairs")
    if outer:
        nothing = F.struct(F.lit(None).cast("string").alias("term"),
                           F.lit(None).cast("bigint").alias("tf"))
        pairs = F.concat(F.array(nothing), F.coalesce(pairs, F.array().cast(PAIRS)))
    return counted.select(*keep, "field", F.inline(pairs))


def count_terms(df: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ("id",)) -> DataFrame:
    """``keep...`` and the counted terms of each field, written once.

    Every function here that takes documents takes these in their place; steps that
    read the documents several times then tokenise and count them once.
    """
    names = [f.counted for f in fields]
    if set(names) <= set(df.columns):
        return df
    return materialize(_counted_side_by_side(df, fields, keep), "counted")


def _counted_side_by_side(df: DataFrame, fields: Sequence[Field], keep: Sequence[str]) -> DataFrame:
    rows = df.select(*dict.fromkeys([*keep, *[f.column for f in fields]]))
    tokens = pin(rows, **{f"_tokens_{f.name}": f.tokens() for f in fields}).select(
        *keep, *[f"_tokens_{f.name}" for f in fields])
    counted = pin(tokens, **{f.counted: pairs_of(f"_tokens_{f.name}", *f.ngrams) for f in fields})
    return counted.select(*keep, *[f.counted for f in fields])


def _counted_rows(df: DataFrame, fields: Sequence[Field], keep: Sequence[str]) -> DataFrame:
    """``keep..., field, pairs``: the distinct terms of a field with their counts."""
    if all(f.counted in df.columns for f in fields):
        return df.select(*keep, F.inline(F.array(*[
            F.struct(F.lit(f.name).alias("field"), F.col(f.counted).alias("pairs")) for f in fields])))
    return _counted_rows(_counted_side_by_side(df, fields, keep), fields, keep)


def known_terms(counts: DataFrame, vocabulary: DataFrame, outer: bool) -> DataFrame:
    """Rows of a term table whose term is in the vocabulary, with its columns.

    ``outer=True`` also keeps the NULL rows of an outer term table. Unknown
    terms, often the most, are gone before anything is sorted or sent. Where the join
    sorts, it compares the term first: a field is the same in most rows.
    """
    if not outer:
        return counts.join(vocabulary, ["term", "field"])
    joined = counts.join(vocabulary, ["term", "field"], "left")
    return joined.where(F.col("idf").isNotNull() | F.col("term").isNull())


def _bound(value: int | float, documents: int) -> float:
    return value if isinstance(value, int) else value * documents


def _per_field(fields: Sequence[Field], value) -> Column:
    chosen = F.lit(None)
    for f in fields:
        chosen = F.when(F.col("field") == f.name, F.lit(value(f))).otherwise(chosen)
    return chosen


def _limit_terms(stats: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """The ``max_features`` most frequent terms per field, ties by term.

    A histogram of the frequencies gives the frequency at the limit; only the
    terms at or above it are ranked, so no task sorts a whole vocabulary.
    """
    limit = _per_field(fields, lambda f: f.max_features)
    histogram = stats.groupBy("field", "tf").agg(F.count(F.lit(1)).alias("c"))
    above = Window.partitionBy("field").orderBy(F.desc("tf")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    cutoffs = (
        histogram.withColumn("before", F.coalesce(F.sum("c").over(above), F.lit(0)))
        .where(F.coalesce(F.col("before") < limit, F.lit(True)))
        .groupBy("field").agg(F.min("tf").alias("cutoff"))
    )
    candidates = stats.join(cutoffs, "field").where(F.col("tf") >= F.col("cutoff"))
    unlimited = [f.name for f in fields if f.max_features is None]
    limited = candidates.where(~F.col("field").isin(unlimited)) if unlimited else candidates
    ranked = limited.withColumn("r", F.row_number().over(
        Window.partitionBy("field").orderBy(F.desc("tf"), "term")
    )).where(F.col("r") <= limit).drop("r")
    if unlimited:
        ranked = ranked.unionByName(candidates.where(F.col("field").isin(unlimited)))
    return ranked.drop("cutoff")


def fit_vocabulary(train: DataFrame, fields: Sequence[Field], documents: int | None = None,
                   id_column: str = "id") -> DataFrame:
    """Vocabulary of the training documents: ``field, term, df, tf, idf``.

    The IDF is smoothed: ``ln((1 + n) / (1 + df)) + 1``. The table is
    materialised, being read by every later step.
    """
    n = train.count() if documents is None else documents
    if all(f.counted in train.columns for f in fields):
        counts = term_table(train, fields, (id_column,)).groupBy("field", "term").agg(
            F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"))
    else:
        # Terms that documents of a slice share are one row before any are sent.
        tokens = train.select(*[f.tokens().alias(f.name) for f in fields])
        parts = document_counts(tokens, {f.name: (f.name, *f.ngrams) for f in fields})
        counts = parts.groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
    low = _per_field(fields, lambda f: float(_bound(f.min_df, n)))
    high = _per_field(fields, lambda f: float(_bound(f.max_df, n)))
    stats = counts.where((F.col("df") >= low) & (F.col("df") <= high))
    if any(f.max_features is not None for f in fields):
        stats = _limit_terms(materialize(stats, "term-stats"), fields)
    idf = F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1
    return materialize(
        stats.select("field", "term", "df", "tf", idf.alias("idf")), "vocabulary"
    )


def raw_weight(fields: Sequence[Field]) -> Column:
    """TF-IDF before normalisation, sublinear where the field says so."""
    damped = [f.name for f in fields if f.sublinear]
    tf = F.col("tf").cast("double")
    if damped:
        tf = F.when(F.col("field").isin(damped), 1 + F.log(tf)).otherwise(tf)
    return tf * F.col("idf")


def term_weights(df: DataFrame, vocabulary: DataFrame, fields: Sequence[Field],
                 keep: Sequence[str] = ("id",), id_column: str = "id",
                 extra: Sequence[str] = (), outer: bool = False) -> DataFrame:
    """``keep..., field, term, extra..., weight``: unit L2 norm per document and field.

    Terms outside the vocabulary are ignored, so a document without any known
    term has no row; ``outer=True`` adds one row with a NULL weight to every
    document and field. ``extra`` names vocabulary columns to carry along.
    """
    counted = all(f.counted in df.columns for f in fields)
    if not counted and all(f.max_features is not None for f in fields):
        # Counting forgets where documents lie. A bounded vocabulary may be broadcast, and then counted ones stay
        # where they are placed; another is joined by term, which moves the terms anyway, so texts are placed.
        df, counted = _counted_side_by_side(df, fields, keep), True
    columns = dict.fromkeys([*keep, *[f.counted if counted else f.column for f in fields]])
    # Clustering documents by id makes the window below need no further exchange.
    placed = df.select(*columns).repartition(id_column)
    counts = term_table(placed, fields, keep, outer)
    columns = dict.fromkeys(["field", "term", "idf", *extra])
    known = known_terms(counts, vocabulary.select(*columns), outer)
    weighted = known.select(*keep, *columns, raw_weight(fields).alias("w"))
    # Clustered by id alone, rows need no further exchange to be grouped by document either.
    document, norm = Window.partitionBy(id_column), F.lit(None)
    for f in fields:
        own = F.col("field") == f.name
        norm = F.when(own, F.sqrt(F.sum(F.when(own, F.col("w") * F.col("w"))).over(document))).otherwise(norm)
    return weighted.select(*keep, "field", "term", *extra, (F.col("w") / norm).alias("weight"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` from all labelled rows."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("count")
    )
    # One row per class is left for the window.
    everything = Window.partitionBy(F.lit(0))
    n, k = F.sum("count").over(everything), F.count(F.lit(1)).over(everything)
    return counts.select(
        "label", "count",
        (n.cast("double") / (k * F.col("count"))).alias("class_weight"),
    )


def index_terms(vocabulary: DataFrame) -> DataFrame:
    """Add ``idx``: dense positions from 0 in (field, term) order.

    Terms are range-partitioned and numbered inside their partition; the only
    global step is a running sum over one count per partition.
    """
    spread = (
        vocabulary.repartitionByRange("field", "term").sortWithinPartitions("field", "term")
        .withColumn("_m", F.monotonically_increasing_id())
    )
    # A row number inside its partition is the low 33 bits of the generated id.
    numbered = materialize(spread.select(
        *vocabulary.columns,
        F.shiftright("_m", 33).alias("_part"),
        F.col("_m").bitwiseAND((1 << 33) - 1).alias("_row"),
    ), "numbered-terms")
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_c")).select(
        "_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_offset")
    )
    return numbered.join(offsets, "_part").select(
        *vocabulary.columns, (F.col("_offset") + F.col("_row")).cast("int").alias("idx")
    )

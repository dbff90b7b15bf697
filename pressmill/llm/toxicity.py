"""Toxicity by Levenshtein automata over a learnt lexicon.

The lexicon is a trie of terms that labelled toxic texts have far more often than
others, and of stems that begin many such terms. The Levenshtein automata of all
terms are intersected with the trie: a state is the set of trie nodes that can be
reached, with the edits so far, and states are made and kept as words need them.
So a word costs one step a letter, and most words leave the automaton after a few.
Words of known harmless texts that lie near a term are exempt from misspellings.

Each hit is looked at in its context window: one inside quotation marks, or near
words that speak about words, counts as quoted. A logistic model over the hits of
a text, by kind, gives the score.

Labels are learnt from a bounded sample (``per_class`` texts a class, ``max_terms``
terms); scoring reads every whole text and shuffles nothing. A null or empty text
has no hits. Repeated rows and null ids are scored each. Without labels of both
classes every score is the smoothed share of toxic labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import (
    Memo, Words, as_texts, class_weights, documents, fit_logistic, labelled_sample, logistic, slices,
)
from pressmill.session import materialize

_PARTS = re.compile(r"[^\W_]+").findall
#: Kinds of hits: the term itself, a misspelling, a word with a learnt stem; then quoted ones.
EXACT, NEAR, STEM, QUOTED = range(4)
WINDOW = 6
_OPENING, _CLOSING, _EITHER = "“„«‹(", "”“»›)", "\"'`"
#: Fixed: words that speak about words.
CUES = frozenset((
    "word", "words", "term", "terms", "quote", "quoted", "called", "saying", "slur", "insult",
    "wort", "begriff", "zitat", "nannte", "mot", "mots", "terme", "citation", "palabra", "palabras",
    "cita", "insulto",
))
_ANY = -1  # the state after a stem: every ending is accepted


@dataclass(frozen=True)
class Model:
    terms: tuple[str, ...]
    stems: tuple[str, ...]
    exempt: frozenset[str]
    coefficients: tuple[float, ...]


def edits_allowed(length: int) -> int:
    return 0 if length < 4 else 1 if length < 8 else 2


class Automaton:
    """All words within reach of a lexicon, as an automaton made on demand."""

    def __init__(self, terms: tuple[str, ...], stems: tuple[str, ...]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.budget = [0]  # most edits of a term below
        self.ends: dict[int, int] = {}  # node -> edits allowed for the term
        self.stem_ends: set[int] = set()
        for term in terms:
            self.ends[self._add(term, edits_allowed(len(term)))] = edits_allowed(len(term))
        for stem in stems:
            self.stem_ends.add(self._add(stem, 0))
        self.sets: list[frozenset] = []
        self.numbers: dict[frozenset, int] = {}
        self.steps: list[dict[str, int | None]] = []
        self.accepts: list[int | None] = []  # least edits of a term that ends here
        self.root = self._state({(0, 0, "")})

    def _add(self, term: str, edits: int) -> int:
        node = 0
        self.budget[0] = max(self.budget[0], edits)
        for letter in term:
            if letter not in self.children[node]:
                self.children[node][letter] = len(self.children)
                self.children.append({})
                self.budget.append(0)
            node = self.children[node][letter]
            self.budget[node] = max(self.budget[node], edits)
        return node

    def _state(self, members: set[tuple[int, int, str]]) -> int | None:
        """Number of the state with these members and all that skipped letters lead to."""
        best: dict[tuple[int, str], int] = {}
        todo = list(members)
        while todo:
            node, edits, awaited = todo.pop()
            if edits > self.budget[node] or best.get((node, awaited), 9) <= edits:
                continue
            best[node, awaited] = edits
            if not awaited:
                todo.extend((child, edits + 1, "") for child in self.children[node].values())
        if not best:
            return None
        if any(node in self.stem_ends and not awaited and not edits for (node, awaited), edits in best.items()):
            return _ANY
        key = frozenset((node, edits, awaited) for (node, awaited), edits in best.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.accepts.append(min((edits for node, edits, awaited in key if not awaited
                                     and node in self.ends and edits <= self.ends[node]), default=None))
        return self.numbers[key]

    def _step(self, state: int, letter: str) -> int | None:
        reached = set()
        for node, edits, awaited in self.sets[state]:
            if awaited:  # the second letter of a swapped pair
                if awaited == letter:
                    reached.add((node, edits, ""))
                continue
            for known, child in self.children[node].items():
                if known == letter:
                    reached.add((child, edits, ""))
                else:
                    reached.add((child, edits + 1, ""))
                    if letter in self.children[child]:
                        reached.add((self.children[child][letter], edits + 1, known))
            reached.add((node, edits + 1, ""))
        return self._state(reached)

    def match(self, word: str) -> int | None:
        """EXACT, NEAR or STEM if the word is within reach."""
        state = self.root
        for letter in word:
            steps = self.steps[state]
            if letter in steps:
                state = steps[letter]
            else:
                if len(self.sets) > 100_000:  # strange input: begin anew, to stay within bounds
                    self.sets.clear(), self.numbers.clear(), self.steps.clear(), self.accepts.clear()
                    self.root = self._state({(0, 0, "")})
                    return self.match(word)
                state = steps[letter] = self._step(state, letter)
            if state is None:
                return None
            if state == _ANY:
                return STEM
        edits = self.accepts[state]
        return None if edits is None else EXACT if edits == 0 else NEAR


class Matcher:
    _loaded: dict[tuple, Matcher] = {}

    def __init__(self, model: Model) -> None:
        self.automaton = Automaton(model.terms, model.stems)
        self.exempt = model.exempt
        self.words = Memo(100_000)

    @classmethod
    def load(cls, model: Model) -> Matcher:
        """One instance for each Python worker."""
        key = (model.terms, model.stems, model.exempt)
        if key not in cls._loaded:
            cls._loaded.clear()
            cls._loaded[key] = cls(model)
        return cls._loaded[key]

    def kind(self, word: str) -> int | None:
        found = self.automaton.match(word)
        return None if found == NEAR and word in self.exempt else found

    def kind_of_raw(self, raw: bytes) -> int:
        """Strongest hit among the parts of a written word, -1 for none."""
        kinds = [k for part in _PARTS(raw.decode().casefold()) if (k := self.kind(part)) is not None]
        return -1 if not kinds else min(kinds, key=(EXACT, STEM, NEAR).index)

    def features(self, column: pa.Array) -> np.ndarray:
        """Per text: log counts of hits by kind, whether it has an unquoted one, and its length."""
        words = Words(column)
        at, code = words.distinct()
        data = words.data.tobytes()
        raw = [data[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist())]
        known = self.words
        for word in known.missing(set(raw)):
            known[word] = self.kind_of_raw(word)
        kinds = np.fromiter(map(known.__getitem__, raw), np.int8, len(raw))
        counts = np.zeros((len(column), 4))
        if len(code):
            hits = np.flatnonzero(kinds[code] >= 0)
            texts = np.searchsorted(words.first, hits, side="right") - 1
            for hit, text in zip(hits.tolist(), texts.tolist()):
                low, high = int(words.first[text]), int(words.first[text + 1])
                if self._quoted(words, data, hit, low, high):
                    counts[text, QUOTED] += 1
                else:
                    counts[text, kinds[code[hit]]] += 1
        strong = counts[:, EXACT] + counts[:, STEM] > 0
        return np.column_stack([np.log1p(counts), strong, counts[:, NEAR] > 0])

    @staticmethod
    def _quoted(words: Words, data: bytes, hit: int, low: int, high: int) -> bool:
        first, last = max(low, hit - WINDOW), min(high, hit + WINDOW + 1) - 1
        start, end = words.starts[hit], words.ends[hit]
        word = data[start:end].decode()
        core = _PARTS(word)
        lead, _, tail = word.partition(core[0]) if core else (word, "", "")
        left = data[words.starts[first]:start].decode() + lead
        right = tail + data[end:words.ends[last]].decode()
        if any(left.count(mark) % 2 and mark in right for mark in _EITHER if mark != "'"):
            return True
        if lead.endswith("'") and "'" in right:
            return True
        if any(left.rfind(a) > left.rfind(b) and b in right for a, b in zip(_OPENING[:-1], _CLOSING[:-1])):
            return True
        return not CUES.isdisjoint(_PARTS((left + " " + right).casefold()))


def _lexicon(sample: DataFrame, max_terms: int, lift: float, support: float
             ) -> tuple[tuple[str, ...], tuple[str, ...], DataFrame]:
    """Terms and stems, and the table of words with the toxic and other texts that have them."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = [(word, label) for label, text in
                    zip(part.column("label").to_pylist(), as_texts(part.column("text")))
                    for word in set(_PARTS(text.casefold()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())],
                ["word", "label"])

    @F.arrow_udf("binary")
    def least_words(column: pa.Array) -> pa.Array:
        keys = []
        for part in slices(iter([pa.RecordBatch.from_arrays([column], ["text"])])):
            words = Words(part.column("text"), lower=True)
            hashes = words.hashes()
            keys += [np.unique(hashes[a:b])[:4].tobytes() for a, b in zip(words.first, words.first[1:])]
        return pa.array(keys, pa.binary())

    # near copies of a text, told by the four least hashes of its words, say nothing new; a toxic one stays
    row = F.struct((-F.col("label")).alias("order"), "text", "label")
    texts = sample.groupBy(least_words("text").alias("key")).agg(F.min(row).alias("row")).select("row.label", "row.text")
    texts = materialize(texts, "texts")
    counted = {row["label"]: row["count"] for row in texts.groupBy("label").count().collect()}
    others, toxic = counted.get(0, 0), max(1, counted.get(1, 0))
    words = materialize(texts.mapInArrow(distinct, "word string, label int").groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other")), "words")
    least = max(3, round(support * toxic))
    telling = (F.col("toxic") / toxic) >= lift * (F.col("other") + 0.5) / max(1, others)
    length = F.explode(F.sequence(F.lit(4), F.lit(8)))
    stems = words.where("length(word) > 4").select("word", "toxic", "other", length.alias("size")) \
        .where("length(word) > size").groupBy(F.expr("left(word, size)").alias("stem")).agg(
            F.sum("toxic").alias("toxic"), F.sum("other").alias("other"),
            F.sum((F.col("toxic") > 0).cast("int")).alias("words")) \
        .where((F.col("toxic") >= 2 * least) & (F.col("words") >= 5) & telling)
    found = {row["stem"]: row["toxic"] for row in stems.orderBy(F.desc("toxic"), "stem").limit(max_terms).collect()}
    # a stem that nearly always goes on the same way is given in full
    tight = {s for s in found if not any(
        t != s and t.startswith(s) and found[t] >= 0.98 * found[s] for t in found)}
    chosen = tuple(sorted(s for s in tight if not any(t != s and s.startswith(t) for t in tight)))
    terms = [row["word"] for row in words.where((F.col("toxic") >= least) & telling & (F.length("word") >= 3))
             .orderBy(F.desc("toxic"), "word").limit(max_terms).collect()]
    return tuple(sorted(t for t in terms if not t.startswith(chosen or ("\0",)))), chosen, words


def fit(docs: DataFrame, labels: DataFrame, label: str, use: Column, per_class: int = 8000,
        max_terms: int = 5000, lift: float = 20.0, support: float = 0.015, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    """Lexicon and weights from the ids of ``labels`` for which ``use`` holds.

    A term is in ``support`` of the toxic texts, and ``lift`` times as often as in others.
    """
    drawn, sizes = labelled_sample(documents(docs, id_col, text_col), labels, label, use, per_class, seed=5)
    share = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    constant = Model((), (), frozenset(), (*[0.0] * 6, float(np.log(share / (1 - share)))))
    if len(sizes) < 2:
        return constant
    sample = materialize(drawn, "sample")
    if sample.select("label").distinct().count() < 2:
        return constant
    terms, stems, words = _lexicon(sample, max_terms, lift, support)
    lexicon = Model(terms, stems, frozenset(), ())

    @F.arrow_udf("boolean")
    def near(column: pa.Array) -> pa.Array:
        matcher = Matcher.load(lexicon)
        return pa.array([matcher.kind(word) == NEAR for word in column.to_pylist()], pa.bool_())

    exempt = frozenset(row["word"] for row in words.where("other > 0").where(near("word")).orderBy(
        F.desc("other"), "word").limit(max_terms).collect())
    model = Model(terms, stems, exempt, ())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher.load(model)
        for part in slices(batches):
            x = matcher.features(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("label").cast(pa.float64()), *map(pa.array, x.T)], ["label", *"abcdef"])

    rows = np.array(sample.select("label", "text").mapInArrow(
        measure, "label double, a double, b double, c double, d double, e double, f double").collect(), float)
    beta = fit_logistic(rows[:, 1:], rows[:, 0], class_weights(rows[:, 0], sizes))
    return Model(terms, stems, exempt, tuple(beta.tolist()))


def score_column(text: Column | str, model: Model) -> Column:
    """Probability that a text is toxic."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        matcher, beta = Matcher.load(model), np.array(model.coefficients)
        out = [np.zeros(0)]
        for part in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
            out.append(logistic(matcher.features(part.column("text")) @ beta[:-1] + beta[-1]))
        return pa.array(np.concatenate(out))

    return score(F.col(text).cast("string") if isinstance(text, str) else text)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row."""
    return documents(docs, id_col, text_col).select("doc_id", score_column("text", model).alias("score"))

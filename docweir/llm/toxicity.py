"""Toxicity scores from a learned lexicon, misspelled terms included, weighed by their context."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from docweir.llm.batches import bounded
from docweir.llm.exact_dedup import content_hash, normalized
from docweir.llm.labelled import is_held_out, training_documents
from docweir.llm.lexicon import LexiconAutomaton, Term
from docweir.storage import materialize

#: Labelled documents that the lexicon and the weights are learned from, at most about.
SAMPLE_BOUND = 16_000
THRESHOLD = 0.3
#: Toxic documents that must hold a term, whatever the size of the sample.
MIN_POSITIVE = 5
#: The part of the terms that may pass for telling by chance (false discovery rate after Benjamini and Hochberg).
MAX_FALSE = 0.05
#: How much likelier a term must be in toxic documents (log of the ratio).
MIN_LOG_RATIO = 3.2
#: Share of harmless documents that may hold unknown words within some edits of a term; a term that has more such neighbours is not met with so many edits.
MAX_NEAR_SHARE = 0.001
STEM_LENGTHS = range(4, 11)
WINDOW = 12
CACHE_BOUND = 150_000
#: What a match counts by its edits, and what a quoted or reported match counts of that.
EDIT_WEIGHTS = (1.0, 0.7, 0.4)
QUOTED_WEIGHT = 0.25
# Words of English, German, French and Spanish that report or mention what others said.
REPORTING = frozenset(
    "said says wrote called quote quoted term word slur insult reported sagte schrieb nannte zitat wort "
    "dit écrit appelé mot terme cité dijo escribió llamó palabra término cita".split()
)
_WORD = re.compile(r"[^\W_]+(?:[@$0-9*!][^\W_]+)*")
# Characters that are written for letters.
_FOLD = str.maketrans("@$013457", "asoieast")
_MARKS = "\"«»“”„"
_MARK = re.compile(f"[{_MARKS}]")
_OPENING = frozenset("\"«“„':‘")


def _last(places: list[int], before: int) -> int:
    """The last of the sorted places before one, or -1."""
    at = bisect_left(places, before)
    return places[at - 1] if at else -1


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def folded(word: str) -> str:
    """A word with look-alike characters replaced, if it has letters as well."""
    return word if word.isalpha() or word.isdigit() else word.translate(_FOLD)


@dataclass
class ToxicityModel:
    """The lexicon, words close to it that are ordinary, and the weights of the features."""

    terms: list[Term] = field(default_factory=list)
    ordinary: frozenset[str] = frozenset()
    prior: float = 0.5
    weights: np.ndarray | None = None
    center: np.ndarray | None = None
    scale: np.ndarray | None = None

    def reader(self) -> TextReader:
        return TextReader(self.terms, self.ordinary)

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.prior)
        z = np.c_[(features - self.center) / self.scale, np.ones(len(features))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class TextReader:
    """Features of whole texts; matches of words are remembered up to a bound."""

    def __init__(self, terms: list[Term], ordinary: frozenset[str]) -> None:
        self.automaton = LexiconAutomaton(terms)
        reader = self

        class Matches(dict):
            def __missing__(self, word):
                plain = folded(word)
                found = reader.automaton.match(plain)
                if found is not None and (found[1] or plain != word) and word in ordinary:
                    found = None
                if found is not None and plain != word:
                    found = (found[0], max(found[1], 1))
                self[word] = found
                return found

        self.matches = Matches()

    def hits(self, text: str) -> list[tuple[str, int, int]]:
        """(word, term, edits) of each match."""
        matches = self.matches
        return [(w, *matches[w]) for w in words_of(text) if matches[w] is not None]

    def features(self, text: str | None) -> list[float]:
        """Weighted matches, the share of words they are, the densest window, the share quoted, and terms seen."""
        if len(self.matches) > CACHE_BOUND:
            self.matches.clear()
        words = words_of(text or "")
        found = list(map(self.matches.__getitem__, words))
        at = [k for k, f in enumerate(found) if f is not None]
        if not at:
            return [0.0] * N_FEATURES
        weight = np.array([EDIT_WEIGHTS[found[k][1]] for k in at])
        quoted = self._quoted(text, words, at)
        weight = weight * np.where(quoted, QUOTED_WEIGHT, 1.0)
        place = np.array(at)
        total = np.r_[0, np.cumsum(weight)]
        dense = (total[1:] - total[np.searchsorted(place, place - 2 * WINDOW)]).max()
        return [
            np.log1p(weight.sum()),
            min(1.0, weight.max()),
            np.log1p(100 * weight.sum() / len(words)),
            np.log1p(dense),
            float(quoted.mean()),
            np.log1p(len({found[k][0] for k in at})),
        ]

    @staticmethod
    def _quoted(text: str, words: list[str], at: list[int]) -> np.ndarray:
        """Which matches stand inside quotation marks of their line, or right after an opening mark that a reporting word leads to."""
        spans = [m.span() for m in _WORD.finditer(text.lower())]
        lowered = text if len(text.lower()) == len(text) else text.lower()
        out, line_end, marks = [], -1, {}
        for k in at:
            start, end = spans[k]
            if start > line_end:
                # The marks of a line are looked up once, from its beginning to its end.
                line_start, line_end = lowered.rfind("\n", 0, start) + 1, lowered.find("\n", end)
                line_end = line_end if line_end >= 0 else len(lowered)
                marks = {m: [] for m in _MARKS}
                for found in _MARK.finditer(lowered, line_start, line_end):
                    marks[found[0]].append(found.start())
            straight = bisect_left(marks['"'], start) % 2 == 1 and marks['"'][-1] >= end
            curved = any(_last(marks[o], start) > _last(marks[c], start) and marks[c] and marks[c][-1] >= end for o, c in (("«", "»"), ("“", "”"), ("„", "“")))
            before = start - 1
            while before >= line_start and lowered[before].isspace():
                before -= 1
            marked = before >= line_start and lowered[before] in _OPENING
            out.append(straight or curved or (marked and any(w in REPORTING for w in words[max(0, k - 3) : k])))
        return np.array(out, dtype=bool)


N_FEATURES = 6


def _terms_in(text: str) -> set[tuple[str, bool]]:
    words = set(words_of(text))
    return {(w, False) for w in words if len(w) >= 3} | {
        (w[:n], True) for w in words if w.isalpha() for n in STEM_LENGTHS if n < len(w)
    }


def _count_terms(train: DataFrame, only: frozenset | None = None) -> DataFrame:
    """(term, stem, n): the documents that hold a term, summed within partitions first."""

    def run(batches):
        seen: Counter = Counter()
        for batch in bounded(batches):
            for text in batch.column("text").to_pylist():
                terms = _terms_in(text or "")
                seen.update(terms if only is None else terms & only)
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in seen], pa.string()), pa.array([s for _, s in seen], pa.bool_()), pa.array(list(seen.values()), pa.int64())],
            names=["term", "stem", "n"],
        )

    return train.select("text").mapInArrow(run, "term string, stem boolean, n bigint").groupBy("term", "stem").agg(F.sum("n").alias("n"))


def _edits(term: str) -> int:
    """The most edits a term or stem of this length is met with."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


def _by_chance(n_with: int, n_without: int, share: float) -> float:
    """The chance that of all documents with a term so many or more are toxic, if each is with the same ``share``."""
    n, log = n_with + n_without, math.lgamma
    terms = (
        log(n + 1) - log(k + 1) - log(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share) for k in range(n_with, n + 1)
    )
    return min(1.0, sum(map(math.exp, terms)))


def _lexicon(positive: dict, negative: dict, n_positive: int, n_negative: int) -> list[Term]:
    """Terms that tell toxic documents, as far as chance is no likely cause; a stem only where it gathers clearly more of them than any word under it."""

    def ratio(key) -> float:
        return np.log((positive[key] + 0.5) / (n_positive + 1)) - np.log((negative.get(key, 0) + 0.5) / (n_negative + 1))

    share, n_candidates = n_positive / (n_positive + n_negative), sum(n >= MIN_POSITIVE for n in positive.values())
    chances = sorted(
        (_by_chance(n, negative.get(k, 0), share), k) for k, n in positive.items() if n >= MIN_POSITIVE and ratio(k) >= MIN_LOG_RATIO
    )
    n_telling = max((i for i, (p, _) in enumerate(chances, 1) if p <= MAX_FALSE * i / n_candidates), default=0)
    telling = {k for _, k in chances[:n_telling]}
    best_word: Counter = Counter()
    for (text, stem), n in positive.items():
        if not stem:
            for length in STEM_LENGTHS:
                if length <= len(text):
                    best_word[text[:length]] = max(best_word[text[:length]], n)
    stems = {t for t, stem in telling if stem and positive[t, True] >= 1.5 * best_word[t]}
    # The stem with the most documents covers longer ones; of stems with as many, the longest is the most exact.
    kept_stems: list[str] = []
    for t in sorted(stems, key=lambda t: (-positive[t, True], -len(t))):
        if not any(t.startswith(k) or k.startswith(t) for k in kept_stems):
            kept_stems.append(t)
    kept = [(positive[t, True], Term(t, True, _edits(t))) for t in kept_stems]
    for t, stem in telling:
        # A word under a stem is met by the stem as it is; it may be met with edits that the stem is not.
        if not stem and (_edits(t) or not t.startswith(tuple(kept_stems))):
            kept.append((positive[t, False], Term(t, max_edits=_edits(t))))
    kept.sort(key=lambda k: (-k[0], k[1].text))
    return [term for _, term in kept]


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = penalty * np.diag(np.r_[np.ones(x.shape[1] - 1), 1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _each_once(sample: DataFrame) -> DataFrame:
    """(y, text) of a bounded sample: texts that are equal without white space are one, with the largest of their labels."""
    copies = sample.groupBy(content_hash(normalized(F.col("text"))).alias("h"))
    return copies.agg(F.max("y").alias("y"), F.min("text").alias("text")).drop("h")


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE_BOUND) -> ToxicityModel:
    """Learn lexicon and weights from at most about ``bound`` labelled documents that are not held out.

    Copies of a text are one document, since a word that only copies hold tells nothing of
    other texts. The sample is the only bound: every term that it shows to be telling enters the
    lexicon, and every near word that its harmless documents hold is known as ordinary.
    Candidates are counted over partitions; those that several toxic documents of the
    sample hold, the near words, and one row of six features for each sampled document
    reach the driver. With no labelled rows, or labels of one kind only, every text scores the share of label 1 (0.5 if none).
    """
    train = materialize(_each_once(training_documents(docs, labels, label, bound)), "toxicity-train")
    sizes = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    n_positive, n_negative = sizes.get(1, 0), sizes.get(0, 0)
    if not n_positive or not n_negative:
        return ToxicityModel(prior=float(n_positive > 0) if sizes else 0.5)
    frequent = _count_terms(train.where("y = 1")).where(F.col("n") >= MIN_POSITIVE - 1)
    positive = {(r.term, r.stem): r.n for r in frequent.collect()}
    negative = {(r.term, r.stem): r.n for r in _count_terms(train.where("y = 0"), frozenset(positive)).collect()}
    model = ToxicityModel(_lexicon(positive, negative, n_positive, n_negative), prior=n_positive / (n_positive + n_negative))

    def near_misses(terms: list[Term]) -> DataFrame:
        """(term, edits, word, n): harmless documents that hold a word, for inexact matches."""

        def run(batches):
            reader = TextReader(terms, frozenset())
            seen: Counter = Counter()
            for batch in bounded(batches):
                for text in batch.column("text").to_pylist():
                    seen.update({(term, edits, word) for word, term, edits in reader.hits(text or "") if edits})
            rows = list(seen.items())
            for part in (rows[k : k + 10_000] for k in range(0, len(rows), 10_000)):
                columns = [*zip(*(key for key, _ in part), strict=True), [n for _, n in part]]
                kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["term", "edits", "word", "n"]
                )

        counted = train.where("y = 0").select("text").mapInArrow(run, "term int, edits int, word string, n bigint")
        return materialize(counted.groupBy("term", "edits", "word").agg(F.sum("n").alias("n")), "toxicity-near")

    terms, ordinary = model.terms, frozenset()
    while True:
        near = near_misses(terms)
        # Words of harmless documents that lie close to a term are words of their own, and no matches.
        ordinary |= {r.word for r in near.select("word").distinct().collect()}
        # As many documents hold a word that is not known yet as hold one that no other holds.
        unknown = near.where("n = 1").groupBy("term", "edits").agg(F.count(F.lit(1)).alias("n")).collect()
        crowd = {(r.term, r.edits): r.n for r in unknown if r.n > MAX_NEAR_SHARE * n_negative}
        # Where too many unknown words come up, fewer edits are allowed; what they were close to may then be another term.
        fewer = [replace(t, max_edits=next((e - 1 for e in range(1, t.max_edits + 1) if (k, e) in crowd), t.max_edits)) for k, t in enumerate(terms)]
        if fewer == terms:
            break
        terms = fewer
    model.terms, model.ordinary = terms, ordinary

    def described(batches):
        reader = TextReader(terms, ordinary)
        for batch in bounded(batches):
            rows = np.array([reader.features(t) for t in batch.column("text").to_pylist()], dtype=np.float64)
            offsets = np.arange(0, rows.size + 1, N_FEATURES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))], names=["y", "x"]
            )

    rows = train.select("y", "text").mapInArrow(described, "y int, x array<double>").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows], dtype=np.float64)
    model.center, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    model.weights = _logistic((x - model.center) / model.scale, y)
    return model


def toxicity_scores(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with ``score`` (0 to 1) and ``predicted`` after its own columns, which must not have these names."""

    def run(batches):
        reader = model.reader()
        for batch in bounded(batches):
            rows = np.array([reader.features(t) for t in batch.column("text").to_pylist()], dtype=np.float64)
            score = model.score(rows.reshape(-1, N_FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text is an input of a score, and all of it, however long. Null and empty
    texts have the score of a text without matches. Without labels every score is 0.5; an
    empty table gives an empty result. Each row stands alone: repeated rows, ties and null doc_ids give a
    row each (a null doc_id is not held out). Other columns are ignored.
    """
    model = fit_toxicity(docs, labels)
    return toxicity_scores(docs.select("doc_id", is_held_out().alias("held_out"), "text"), model).drop("text")

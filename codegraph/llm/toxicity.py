"""Operator 7, toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, drops accents, turns homoglyphs and the digits and signs used for letters into those letters (digits only in
a token that has letters as well) and all that is no letter or digit into one space. Terms are whole folded words,
and stems that begin a word. The weight of a term is its log odds among toxic and other documents; phrases of a term
and a neighbour that are found in clean documents are exceptions, whose occurrences count nothing. The sum of weights
and its share of the document's words give the score through a logistic curve.

Lexicon, exceptions and curve are learnt on the driver from a bounded sample of labelled training rows (SAMPLE rows,
those with the smallest hash of doc_id); scoring goes through every row in one pass without a shuffle.

Defined results: a null text is the empty one; empty texts have the curve's value at no hit; with no labelled
training row, or one label only, scores are that label's share; null labels and doc_ids don't train; repeated rows
are scored each; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clear_names, fold_hash, forget

SAMPLE = 8000
SAMPLE_BYTES = 64 << 20
THRESHOLD = 0.3
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_ODDS = 5, 0.015, 3.0
STEM_LENGTHS = range(4, 9)
TERM_LIMIT = 20_000

#: Letters that look like Latin ones, and digits and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ł": "l", "ø": "o",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "€": "e", "|": "i"}


class _Fold(dict):
    """Replacement of each character, found out once. Signs for letters are kept until a token is seen to have letters."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if char in DIGITS or char in SIGNS or char == "!":
            out = char
        else:
            base = unicodedata.normalize("NFKD", char).lower()
            out = "".join(HOMOGLYPHS.get(c, c if c.isalnum() else " ") for c in base if not unicodedata.combining(c)) if base else " "
            if unicodedata.category(char) in ("Cf", "Mn"):
                out = ""
        self[code] = out
        return out


FOLD = _Fold()
LEET = str.maketrans(DIGITS | SIGNS | {"!": "i"})


def fold(text: str | None) -> str:
    """Folded words with one space around each."""
    words = []
    for word in (text or "").translate(FOLD).split():
        if not word.isalpha():
            bare = word.rstrip("!").lstrip("!|")
            if any(map(str.isalpha, bare)):
                word = bare.translate(LEET)
            else:
                word = "".join(c for c in word if c.isdigit())
            if not word:
                continue
        words.append(word)
    return f" {' '.join(words)} " if words else " "


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)
    exceptions: dict[str, str] = field(default_factory=dict)
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    constant: float | None = None


class Matcher:
    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        self.machine = ahocorasick.Automaton()
        for term, weight in model.terms.items():
            self.machine.add_word(term, (len(term), weight, term))
        for phrase, term in model.exceptions.items():
            self.machine.add_word(phrase, (len(phrase), 0.0, term))
        if len(self.machine):
            self.machine.make_automaton()

    def weigh(self, folded: str) -> tuple[float, int]:
        """Weights of the words hit, each word once by its heaviest term, and the number of words."""
        words = folded.count(" ") - 1 if len(folded) > 1 else 0
        if not len(self.machine):
            return 0.0, words
        hits: dict[int, float] = {}
        spared: set[int] = set()
        for end, (length, weight, term) in self.machine.iter(folded):
            begin = end - length + 1
            if weight:
                hits[begin] = max(weight, hits.get(begin, 0.0))
            else:
                spared.add(begin + folded[begin : end + 1].index(term))
        return sum(w for at, w in hits.items() if at not in spared), words

    def score(self, text: str | None) -> float:
        if self.model.constant is not None:
            return self.model.constant
        return curve_value(self.model.curve, *self.weigh(fold(text)))


def features(weight: float, words: int) -> tuple[float, float]:
    """The total and the length-normalised weight, on log scales."""
    return math.log1p(weight), math.log1p(1000.0 * weight / (words + 20))


def curve_value(curve: tuple[float, float, float], weight: float, words: int) -> float:
    a, b = features(weight, words)
    z = curve[0] + curve[1] * a + curve[2] * b
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit_curve(rows: list[tuple[float, int]], labels: list[int], ridge: float = 1.0) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a ridge on the slopes; a negative slope is set to 0."""
    x = np.array([(1.0, *features(*r)) for r in rows])
    y = np.array(labels, float)
    free = np.ones(3, bool)
    for _ in range(3):
        beta = np.zeros(3)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            penalty = np.diag([1e-6, ridge, ridge])
            gradient = x.T @ (y - p) - penalty @ beta
            hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
            step = np.zeros(3)
            step[free] = np.linalg.solve(hessian[np.ix_(free, free)], gradient[free])
            beta += step
            if np.abs(step).max() < 1e-8:
                break
        if (beta[1:] >= 0).all():
            break
        free[1:] &= beta[1:] >= 0
    return tuple(float(b) for b in beta)


def candidates(words: list[str]) -> set[str]:
    """Terms of one document: whole words, and stems that a longer word begins with."""
    found = set()
    for w in set(words):
        found.add(f" {w} ")
        found.update(f" {w[:n]}" for n in STEM_LENGTHS if len(w) > n)
    return found


def learn(rows: list[tuple[str | None, int]]) -> Model:
    """A model from (text, label) rows."""
    labels = [int(y) for _, y in rows]
    if not rows or len(set(labels)) < 2:
        return Model(constant=float(labels[0]) if rows else 0.0)
    folded = [fold(t) for t, _ in rows]
    counts = {0: Counter(), 1: Counter()}
    for text, y in zip(folded, labels, strict=True):
        counts[y].update(candidates(text.split()))
    total = {y: labels.count(y) for y in (0, 1)}
    odds = {t: math.log((n + 0.1) / (total[1] + 0.2)) - math.log((counts[0][t] + 0.1) / (total[0] + 0.2)) for t, n in counts[1].items() if n >= max(LEAST_DOCUMENTS, LEAST_SHARE * total[1])}
    kept: dict[str, float] = {}
    for t in sorted((t for t in odds if odds[t] >= LEAST_ODDS), key=lambda t: (len(t), t)):
        stem = next((t[:k] for k in range(4, len(t)) if t[:k] in kept), None)
        if stem is None or odds[t] > kept[stem] + 1:
            kept[t] = odds[t]
    kept = dict(sorted(kept.items(), key=lambda x: (-x[1], x[0]))[:TERM_LIMIT])
    model = Model(terms=kept)
    matcher = Matcher(model)
    clean, dirty = Counter(), Counter()
    for text, y in zip(folded, labels, strict=True):
        if not len(matcher.machine):
            break
        found = set()
        for end, (length, _, term) in matcher.machine.iter(text):
            begin = end - length + 1
            stop = text.index(" ", begin + 1) + 1
            before = text.rfind(" ", 0, begin)
            after = text.find(" ", stop)
            found |= {(text[before:stop], term)} if before >= 0 else set()
            found |= {(text[begin : after + 1], term)} if after >= 0 else set()
        (dirty if y else clean).update(found)
    model.exceptions = {phrase: term for (phrase, term), n in clean.items() if n >= 3 and n > 5 * dirty[phrase, term]}
    matcher = Matcher(model)
    model.curve = fit_curve([matcher.weigh(t) for t in folded], labels)
    return model


def training_rows(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[str | None, int]]:
    """At most `sample` labelled rows outside the held-out fold, in the order of a hash of doc_id, and SAMPLE_BYTES of text:
    ids are picked, and texts measured, before any text goes to the driver."""
    picked = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~fold_hash(F.col("doc_id"), 4, 2))
    picked = picked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    ids = [(r.doc_id, r.toxic) for r in picked.collect()]
    if not ids:
        return []
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = F.broadcast(spark.createDataFrame(ids, "doc_id long, toxic int"))
    size = {r.doc_id: r.n or 0 for r in texts.select("doc_id", F.octet_length("text").alias("n")).join(asked, "doc_id").groupBy("doc_id").agg(F.max("n").alias("n")).collect()}
    fits = itertools.accumulate(size.get(i, 0) for i, _ in ids)
    ids = [row for row, total in zip(ids, fits, strict=True) if total <= SAMPLE_BYTES]
    bounded = F.broadcast(spark.createDataFrame(ids, "doc_id long, toxic int"))
    rows = texts.join(bounded, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic")).collect()
    return [(r.text, r.toxic) for r in sorted(rows, key=lambda r: r.doc_id)]


def score_documents(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted, n_hits weight, n_words) of every whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        forget()
        matcher = Matcher(shared.value)
        for batch in batches:
            scores, weights, words = [], [], []
            for text in batch.column("text").to_pylist():
                w, n = matcher.weigh(fold(text))
                weights.append(w)
                words.append(n)
                scores.append(matcher.model.constant if matcher.model.constant is not None else curve_value(matcher.model.curve, w, n))
            flags = [int(s >= threshold) for s in scores]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores, pa.float64()), pa.array(flags, pa.int32()), pa.array(weights, pa.float64()), pa.array(words, pa.int64())], ["doc_id", "score", "predicted", "weight", "n_words"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int, weight double, n_words long")


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, weight, n_words of every document."""
    model = learn(training_rows(documents, labels))
    return score_documents(documents, model).select("doc_id", fold_hash(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted", "weight", "n_words")


def keep_clean(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that the lexicon doesn't reject."""
    model = learn(training_rows(documents, labels))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    plain, names = clear_names(documents)
    text = names["text"]

    def run(batches):
        forget()
        matcher = Matcher(shared.value)
        for batch in batches:
            keep = [matcher.score(t) < THRESHOLD for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*documents.columns)

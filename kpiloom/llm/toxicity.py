"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

Sentence s has probability ``p_s = sigmoid(bias + sum of its words' weights)``;
a document has ``1 - prod(1 - p_s)`` (noisy-or).  Only documents are labelled.
The gradient of the document likelihood reaches the sentences through the
noisy-or, so the fitted sentence scores tell where the offence is.
A word's weight is the sum of its own weight and that of its first letters, so
inflected forms of a known stem count as well.
"""

from __future__ import annotations

import array
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import in_fold, labelled_sample, with_text

SAMPLE_DOCS = 2000  # expected documents per label to fit on, chosen by a hash of the id
STEMS = (4, 5)  # letters
LEAST_Z = 4.0  # a feature whose document frequency differs less between the labels has no weight
STEPS = 400
RATE = 0.1
RIDGE = 2e-5
CACHE_ENTRIES = 400_000

_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")  # a word, or the end of a sentence
_SENTENCE = re.compile(r"[.!?\n]")
_ENDS = ".!?\n"


@dataclass
class SentenceModel:
    bias: float
    words: dict[str, float]
    stems: dict[int, dict[str, float]]  # by number of letters

    def of_word(self, word: str) -> float:
        z = self.words.get(word, 0.0)
        for k, weights in self.stems.items():
            z += weights.get(word[:k], 0.0)
        return z


class WordScores(dict):
    """Log-odds of words; the ends of sentences are NaN.  Keeps a bounded number of words."""

    def __init__(self, model: SentenceModel) -> None:
        super().__init__({end: float("nan") for end in _ENDS})
        self.model = model

    def __missing__(self, word: str) -> float:
        z = self.model.of_word(word)
        if len(self) < CACHE_ENTRIES and len(word) < 40:
            self[word] = z
        return z


def tokens(text: str | None) -> list[str]:
    """Words in lower case and the marks that end sentences."""
    return _TOKEN.findall(text.lower()) if text else []


def sentence_scores(text: str | None, scores: WordScores) -> np.ndarray:
    """Log-odds of every sentence that has a word."""
    words = tokens(text)
    z = np.fromiter(map(scores.__getitem__, words), np.float64, len(words))
    ends = np.isnan(z)
    z[1:][z[1:] == z[:-1]] = 0.0  # a word repeated in a row counts once
    of = np.cumsum(ends)[~ends]
    total, n = np.bincount(of, z[~ends]), np.bincount(of)
    return total[n > 0] + scores.model.bias


def _words(sentence: str) -> str:
    return " ".join(_TOKEN.findall(sentence))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def train(texts: list[str], labels: np.ndarray, weight: np.ndarray, steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE) -> SentenceModel:
    """Full-batch Adam on the noisy-or likelihood of document labels; document weights sum to 1."""
    index: dict[str, int] = {}
    word_of, sentence_of, doc_of = array.array("i"), array.array("i"), array.array("i")
    for d, text in enumerate(texts):
        fresh, previous = True, ""
        for word in tokens(text):
            if word in _ENDS or word == previous:
                fresh |= word in _ENDS
                continue
            previous = word
            if fresh:
                doc_of.append(d)
                fresh = False
            word_of.append(index.setdefault(word, len(index)))
            sentence_of.append(len(doc_of) - 1)
    word_of, sentence_of, doc_of = (np.frombuffer(a, np.int32) if len(a) else np.zeros(0, np.int32) for a in (word_of, sentence_of, doc_of))
    n_words, n_sent, n_docs = len(index), len(doc_of), len(texts)
    if not n_sent or labels.min() == labels.max():
        return SentenceModel(8.0 if n_docs and labels.min() == 1 else -20.0, {}, {})
    # Features: the words, then their stems; part[k] maps words to features.
    groups, part, n_features = [index], [np.arange(n_words)], n_words
    for k in STEMS:
        stems: dict[str, int] = {}
        part.append(n_features + np.array([stems.setdefault(w[:k], len(stems)) for w in index], np.int64))
        groups.append(stems)
        n_features += len(stems)

    doc_of_word = doc_of[sentence_of]
    n_of = np.array([(labels == 0).sum(), (labels == 1).sum()])
    known = np.zeros(n_features, bool)
    for of in part:
        pairs = np.unique(of[word_of] * np.int64(n_docs) + doc_of_word)
        feature, label = pairs // n_docs, labels[pairs % n_docs]
        held = np.stack([np.bincount(feature[label == k], minlength=n_features) for k in (0, 1)])
        pooled = held.sum(axis=0) / n_docs
        error = np.sqrt(pooled * (1 - pooled) * (1 / n_of).sum())
        known |= np.abs(held[1] / n_of[1] - held[0] / n_of[0]) >= LEAST_Z * np.maximum(error, 1e-12)
    # Words without such a feature never move a sentence; they need not be visited in the steps below.
    live = np.any([known[of] for of in part], axis=0)[word_of]
    word_of, sentence_of = word_of[live], sentence_of[live]
    theta = np.zeros(n_features + 1)
    theta[-1] = -6.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        per_word = sum(theta[of] for of in part)
        z = theta[-1] + np.bincount(sentence_of, per_word[word_of], n_sent)
        none = np.bincount(doc_of, np.logaddexp(0, z), n_docs)  # -log of "no sentence is toxic"
        # Slope of the loss by ``none``: 1 for clean documents, -P(none) / P(some) for toxic ones.
        slope = weight * np.where(labels == 1, -1 / np.expm1(np.clip(none, 1e-9, 500)), 1.0)
        by_z = slope[doc_of] * _sigmoid(z)
        by_word = np.bincount(word_of, by_z[sentence_of], n_words)
        gradient = np.append(sum(np.bincount(of, by_word, n_features) for of in part) * known, by_z.sum())
        gradient[:-1] += ridge * theta[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights, at = [], 0
    for group in groups:
        weights.append({w: float(v) for w, v in zip(group, theta[at : at + len(group)]) if abs(v) > 1e-3})
        at += len(group)
    return SentenceModel(float(theta[-1]), weights[0], dict(zip(STEMS, weights[1:])))


def fit(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "toxic", sample_docs: int = SAMPLE_DOCS, seed: int = 5) -> SentenceModel:
    """Fit on about ``sample_docs`` labelled documents of each label; rows without text, id or label are left out.

    Conflicting labels of one document count as the greatest of them.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col(f"`{ident}`").alias("id")).agg(F.max(f"`{label}`").cast("int").alias("label"))
    rows = labelled_sample(docs, ident, text, marks, sample_docs, seed)
    weight = 1 / rows["share"].to_numpy(np.float64)  # the sample stands for the frequency of the labels
    return train(rows["text"].tolist(), rows["label"].to_numpy(np.int64), weight / max(weight.sum(), 1e-9))


def score(docs: DataFrame, model: SentenceModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, ``n_sentences``, ``worst`` (number of the worst sentence) and ``worst_score``.

    A text without words has no sentence: score 0, ``worst`` null.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("score double, n_sentences int, worst int, worst_score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores = WordScores(SentenceModel(**held.value))
        for texts in batches:
            out = []
            for text_ in texts:
                z = sentence_scores(text_, scores)
                if len(z):
                    worst = int(z.argmax())
                    out.append((float(-np.expm1(-np.logaddexp(0, z).sum())), len(z), worst, float(_sigmoid(z[worst]))))
                else:
                    out.append((0.0, 0, None, 0.0))
            frame = pd.DataFrame(out, columns=["score", "n_sentences", "worst", "worst_score"])
            yield frame.astype({"worst": "Int32"})

    return docs.withColumn("_tox", run(F.col(f"`{text}`"))).select(*[F.col(f"`{c}`") for c in docs.columns], "_tox.*")


def offending(docs: DataFrame, model: SentenceModel, ident: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """One row per offending sentence: ``ident``, ``sentence`` (its number), ``words``, ``sentence_score``."""
    held = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = WordScores(SentenceModel(**held.value))
        for batch in batches:
            rows = []
            for doc, text_ in zip(batch[ident], batch[text]):
                p = _sigmoid(sentence_scores(text_, scores))
                if (p >= least).any():
                    found = [w for w in map(_words, _SENTENCE.split(text_.lower())) if w]
                    rows += [(doc, int(k), found[k], float(p[k])) for k in np.flatnonzero(p >= least)]
            yield pd.DataFrame(rows, columns=[ident, "sentence", "words", "sentence_score"])

    kept = with_text(docs, ident, text).where(F.col(text).isNotNull() & F.col(ident).isNotNull())
    return kept.mapInPandas(run, f"`{ident}` {kept.schema[ident].dataType.simpleString()}, sentence int, words string, sentence_score double")


def toxicity(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5, held_out: int = 0, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per document: ``ident``, ``held_out``, ``score``, ``predicted``, and where the worst sentence is.

    Labels of the held-out fold are never read.
    """
    model = fit(docs, labels.where(~in_fold(ident, folds, held_out)), ident, text, label, sample_docs)
    rows = with_text(docs, ident, text).select(ident, in_fold(ident, folds, held_out).alias("held_out"), text)
    scored = score(rows, model, text)
    return scored.select(ident, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "worst", "worst_score")

"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad.  A line's score comes from its own shape
and that of its neighbours, transitions tie consecutive lines together, and
forward-backward gives each line's marginal probability to be good.  A
document's quality is the mean of these marginals weighted by line length.

Line labels are hidden.  A document's label is taken for a noisy sign that every
line gives of itself: lines of good documents are rarely bad, lines of bad
documents often good.  Fitting maximises the likelihood of these signs; its gradient
is the difference of two forward-backward passes, with the signs and without.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import in_fold, labelled_sample, with_text

SAMPLE_DOCS = 1500  # expected documents per label to fit on, chosen by a hash of the id
STEPS = 220
RATE = 0.05
RIDGE = 1e-4
STEADY = 0.05  # ridge of the transitions, so that a block of other lines is not talked over by the rest
GOOD_SIGN = (0.97, 0.06)  # how often a good and a bad line stand in a good document
BAD_SIGN = (0.35, 0.95)  # how often a good and a bad line stand in a bad document, up to a common factor
THRESHOLD = 0.3
_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _BAR, _MARK, _HIGH = range(8)
_KINDS = 8


def _classes() -> np.ndarray:
    """Bit set of each byte's kinds."""
    kind = np.zeros(256, np.uint8)
    for k, members in (
        (_UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        (_LOWER, b"abcdefghijklmnopqrstuvwxyz"),
        (_DIGIT, b"0123456789"),
        (_SPACE, b" \t\r\x0b\x0c"),
        (_STOP, b".,;:!?"),
        (_BAR, b"|<>{}[]=/\\_"),
        (_MARK, b"!#$%&*+@^~"),
    ):
        for b in members:
            kind[b] |= 1 << k
    kind[128:] |= 1 << _HIGH
    return kind


_CLASS = _classes()


def line_shapes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, the document of each, and its length in bytes.

    A text without a line break is one line; an empty text is one empty line.
    """
    lines, doc, again, distinct, words = [], [], [], [], []
    for d, raw in enumerate(texts):
        seen = set()
        for line in raw.split(b"\n"):
            parts = line.split()
            lines.append(line)
            doc.append(d)
            again.append(line in seen)
            seen.add(line)
            words.append(len(parts))
            distinct.append(len(set(parts)))
    size = np.array([len(x) for x in lines], np.int64)
    data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    starts = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    kinds = _CLASS[data]
    share = np.stack([np.add.reduceat((kinds >> k) & 1, starts, dtype=np.int64) for k in range(_KINDS)], axis=1) / np.maximum(size, 1)[:, None]
    words, distinct = np.array(words), np.array(distinct)
    variety = distinct / np.maximum(words, 1)
    mean_word = size / np.maximum(words, 1)
    own = np.column_stack(
        [
            share,
            np.sqrt(share[:, [_UPPER, _DIGIT, _BAR, _MARK]]),
            share[:, _UPPER] > 0.4,
            share[:, _MARK] > 0.05,
            share[:, _BAR] > 0.03,
            np.log1p(size) / 8,
            size == 0,
            words <= 2,
            variety * (words > 4),
            (variety < 0.5) & (words > 4),
            (variety < 0.2) & (words > 8),
            np.minimum(mean_word, 30) / 30,
            np.array(again) & (size > 0),
        ]
    ).astype(np.float32)
    return own, np.array(doc), size


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A constant, the line's own shape, and the shapes of the lines before and after it."""
    own, doc, size = line_shapes(texts)
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = doc[1:] == doc[:-1]
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    edge = np.zeros((len(own), 2), np.float32)
    edge[1:, 0], edge[:-1, 1] = same, same
    return np.concatenate([np.ones((len(own), 1), np.float32), own, before, after, edge], axis=1), doc, size


def _by_rank(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents by descending number of lines: first line, number of lines, and how many have a t-th line."""
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    n = np.diff(np.append(first, len(doc)))
    order = np.argsort(-n, kind="stable")
    first, n = first[order], n[order]
    active = len(n) - np.searchsorted(n[::-1], np.arange(1, n[0] + 1))
    return first, n, active


def marginals(score: np.ndarray, doc: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each line to be good, and the expected number of each transition.

    ``score`` is a line's advantage of good (1) over bad (0).  All documents
    advance together, one line per step.
    """
    first, n, active = _by_rank(doc)
    total = len(score)
    forward, backward = np.empty((total, 2)), np.zeros((total, 2))
    unary = np.stack([np.zeros(total), score], axis=1)
    for t, k in enumerate(active):
        at = first[:k] + t
        if t == 0:
            forward[at] = unary[at]
        else:
            step = forward[at - 1][:, :, None] + transition
            forward[at] = unary[at] + np.logaddexp(step[:, 0], step[:, 1])
    for t in range(len(active) - 1, 0, -1):
        at = first[: active[t]] + t
        step = transition + (unary[at] + backward[at])[:, None, :]
        backward[at - 1] = np.logaddexp(step[:, :, 0], step[:, :, 1])
    last = first + n - 1
    whole = np.logaddexp(forward[last, 0], forward[last, 1])
    of = np.empty(total)
    of[np.concatenate([np.arange(a, a + m) for a, m in zip(first, n)])] = np.repeat(whole, n)
    good = np.exp(forward[:, 1] + backward[:, 1] - of)
    follows = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    pair = forward[follows - 1][:, :, None] + transition + (unary[follows] + backward[follows])[:, None, :] - of[follows][:, None, None]
    return np.clip(good, 0, 1), np.exp(pair)


@dataclass
class LineField:
    weights: np.ndarray
    transition: np.ndarray

    def lines(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of every line to be good, with the line's text number and length."""
        x, doc, size = features(texts)
        return marginals(x @ self.weights, doc, self.transition)[0], doc, size

    def quality(self, texts: list[bytes]) -> np.ndarray:
        good, doc, size = self.lines(texts)
        length = np.maximum(size, 1)
        return np.bincount(doc, good * length, len(texts)) / np.bincount(doc, length, len(texts))


def train(texts: list[bytes], labels: np.ndarray, steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE) -> LineField:
    """Adam on the log likelihood of the documents' signs; both labels weigh the same, as do documents within a label."""
    x, doc, size = features(texts)
    lines = np.bincount(doc, minlength=len(texts))
    share = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1))
    weight = (share / np.maximum(lines, 1))[doc]
    sign = np.where(labels == 1, np.log(GOOD_SIGN[0] / GOOD_SIGN[1]), np.log(BAD_SIGN[0] / BAD_SIGN[1]))[doc]
    follows = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    theta = np.zeros(x.shape[1] + 4)
    shrink = np.concatenate([np.full(x.shape[1], ridge), np.full(4, STEADY)])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        transition = theta[-4:].reshape(2, 2)
        score = x @ theta[:-4]
        good, expected = marginals(score, doc, transition)
        told, told_pairs = marginals(score + sign, doc, transition)
        by_score = (good - told) * weight
        by_pair = ((expected - told_pairs) * weight[follows][:, None, None]).sum(axis=0)
        gradient = np.concatenate([by_score @ x, by_pair.ravel()]) + shrink * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return LineField(theta[:-4].astype(np.float32), theta[-4:].reshape(2, 2))


def _raw(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "replace")


def fit(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "quality", sample_docs: int = SAMPLE_DOCS, seed: int = 5) -> LineField | None:
    """Fit on about ``sample_docs`` labelled documents of each label; None without labelled rows.

    Conflicting labels of one document count as the least of them.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col(f"`{ident}`").alias("id")).agg(F.min(f"`{label}`").cast("int").alias("label"))
    rows = labelled_sample(docs, ident, text, marks, sample_docs, seed)
    return train([_raw(t) for t in rows["text"]], rows["label"].to_numpy(np.int64)) if len(rows) else None


def score(docs: DataFrame, field: LineField | None, text: str = "text", group: int = 4 << 20) -> DataFrame:
    """``docs`` with ``score``; null and empty texts are one empty line.  Without a fitted field the score is 0.5."""
    held = docs.sparkSession.sparkContext.broadcast(field and vars(field))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        field = LineField(**held.value) if held.value else None
        for texts in batches:
            if field is None:
                yield pd.Series(np.full(len(texts), 0.5))
                continue
            raw = [_raw(t) for t in texts]
            ends = np.cumsum([len(r) for r in raw])
            out, at = [], 0
            while at < len(raw):  # some MB of text at a time
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + group)))
                out.append(field.quality(raw[at:to]))
                at = to
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn("score", run(F.col(f"`{text}`")))


def quality(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 5, held_out: int = 0, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per document: ``ident``, ``held_out``, ``score``, ``predicted``.  Labels of the held-out fold are never read.

    Null and empty texts count as one empty line.  Rows that repeat are scored alike; labels of one document that
    differ count as the least of them.  Other columns are not read, whatever their names.  An empty table gives no rows.
    """
    field = fit(docs, labels.where(~in_fold(ident, folds, held_out)), ident, text, label, sample_docs)
    rows = with_text(docs, ident, text).select(ident, in_fold(ident, folds, held_out).alias("held_out"), text)
    scored = score(rows, field, text)
    return scored.select(ident, "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

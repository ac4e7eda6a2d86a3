"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text terms is shared by all grades; ordered thresholds cut its score
into grades: P(grade >= k) = sigmoid(score - threshold_k).
"""

import operator
from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, columns_of, fresh, map_rows
from .fitting import Adam, Sparse, fit_in_task, sigmoid, training_sample

SLOTS = 1 << 18
_SHAPE = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c
    for c in range(256))


def _slots(terms, kind: int):
    return np.fromiter((crc32(t, kind) for t in terms), np.int64, len(terms)) & (SLOTS - 1)


def features(text: bytes):
    """(slots, values): words by tempered frequency, word shapes by share, and repetition levels."""
    words = text.lower().split()
    n = len(words)
    counts = Counter(words)
    tempered = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    tempered /= max(1e-9, np.sqrt(np.square(tempered).sum()))
    shapes = Counter([w[:1] + w[-2:] for w in text.translate(_SHAPE).split()])
    share = np.fromiter(shapes.values(), np.float64, len(shapes)) / max(1, n)
    again = sum(map(operator.eq, words, words[1:])) / max(1, n)
    lines = text.split(b"\n")
    levels = [b"again%d" % (10 * again), b"words%d" % n.bit_length(),
              b"different%d,%d" % (n.bit_length(), 10 * len(counts) / max(1, n)),
              b"lines%d" % (10 * len(set(lines)) / len(lines))]
    return (np.concatenate([_slots(counts, 1), _slots(shapes, 2), _slots(levels, 3)]),
            np.concatenate([tempered, 2 * share, np.full(len(levels), 0.5)]))


def fit(texts, y, grades: int, steps: int = 150, rate: float = 0.1, ridge: float = 1e-4):
    """(weights, thresholds) for grades 0 .. grades - 1. Without rows all weights are 0."""
    w, cut = np.zeros(SLOTS), np.zeros(grades - 1)
    known = (y >= 0) & (y < grades)   # rows with other grades are left out
    texts, y = [t for t, ok in zip(texts, known) if ok], y[known]
    if not len(y):
        return w.astype(np.float32), cut
    x = Sparse([features(t) for t in texts])
    # The first threshold and the logarithms of the gaps: so the thresholds stay ordered.
    share = np.clip([(y <= k).mean() for k in range(grades - 1)], 0.01, 0.99)
    start = np.log(share / (1 - share))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    adam, n = Adam(rate, SLOTS, grades - 1), len(y)
    for _ in range(steps):
        cut = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        score = x.times(w)
        ends = np.concatenate([[-np.inf], cut, [np.inf]])
        up, low = sigmoid(ends[y + 1] - score), sigmoid(ends[y] - score)
        p = np.maximum(up - low, 1e-9)
        by_cut = np.bincount(y, -up * (1 - up) / p, grades)[:-1] + np.bincount(y, low * (1 - low) / p, grades)[1:]
        after = np.cumsum(by_cut[::-1])[::-1] / n
        adam.step([w, free], [x.back(1 - up - low, SLOTS) / n + ridge * w,
                              after * np.concatenate([[1.0], np.exp(free[1:])])])
    return w.astype(np.float32), np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def _model(docs, labels, rating, grades, train_rows):
    return fit_in_task(training_sample(docs, labels, rating, train_rows), lambda t, y: fit(t, y, grades))


def _tails(texts, w, cut):
    """P(grade >= k) of each text, one column for each k from 1."""
    score = np.empty(len(texts))
    for n, text in enumerate(texts):
        slots, values = features(text)
        score[n] = w[slots] @ values
    return sigmoid(score[:, None] - cut[None, :])


def grade(docs: DataFrame, labels: DataFrame, rating, grades: int, good: int = 1, least: float = 0.5,
          train_rows: int = 10_000) -> DataFrame:
    """One row for each row of `docs`: doc_id, expected_grade, p_good = P(grade >= good), kept
    (p_good >= least).

    `rating` is a column of `labels` with whole grades from 0; the model is fitted on a sample of at
    most `train_rows` labelled documents and scores every row. Null and empty texts are scored by
    their empty word list. Without labels p_good is 0.5 for all. Repeated rows stay; other columns
    are not read.
    """
    w, cut = _model(docs, labels, rating, grades, train_rows)

    def rows(ids, texts):
        tail = _tails(texts, w, cut)
        yield ids, tail.sum(axis=1), tail[:, good - 1], tail[:, good - 1] >= least

    return map_rows(docs.select("doc_id", as_bytes()), rows,
                    "doc_id long, expected_grade double, p_good double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, rating, grades: int, good: int = 1, least: float = 0.5,
              train_rows: int = 10_000) -> DataFrame:
    """The rows of `docs` that `grade` keeps, with their columns."""
    w, cut = _model(docs, labels, rating, grades, train_rows)

    def rows(*columns):
        kept = np.flatnonzero(_tails(columns[-1], w, cut)[:, good - 1] >= least)
        yield tuple([c[n] for n in kept] for c in columns[:-1])

    content, = fresh(docs, "content")
    return map_rows(docs.withColumn(content, as_bytes()), rows, columns_of(docs))


def rating():
    """Graded rating from the two labels: 0 poor, 1 well written but toxic, 2 good. A text without
    a toxic label counts as not toxic."""
    return F.col("quality") * (2 - F.coalesce(F.col("toxic"), F.lit(0)))

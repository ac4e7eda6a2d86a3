"""Toxicity by a factorization machine over hashed terms.

Besides a weight, each term has a short vector; the product of two terms' vectors is the weight of
meeting both in a text, which an additive model has no place for.
"""

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, map_rows
from .fitting import Adam, Sparse, fit_in_task, sigmoid, training_sample

SLOTS = 1 << 20
PREFIXES = (4, 5, 6)
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))


def terms(text: bytes):
    """Slots of a text's different words and word beginnings, each once."""
    words = set(text.translate(_LETTERS).split())
    out = [crc32(w) for w in words]
    for size in PREFIXES:
        out += [crc32(p, size) for p in {w[:size] for w in words if len(w) >= size}]
    return np.unique(np.array(out, np.int64) & (SLOTS - 1))


def _by_pairs(rows, y, often, strength, effect, block=2000):
    """Of the slots `often`, those that go together with another one otherwise in one class than in the
    other: their correlations in the two classes differ by so many standard errors and at least by `effect`,
    which small differences in the mix of texts don't reach however many rows there are."""
    sizes = [(y == k).sum() for k in (1, 0)]
    if not len(often) or min(sizes) == 0:
        return often[:0]
    place = np.full(SLOTS, -1, np.int64)
    place[often] = np.arange(len(often))
    covariance, share = [], np.zeros(len(often))
    for k, n in zip((1, 0), sizes):
        own = np.flatnonzero(y == k)
        both = np.zeros((len(often), len(often)))
        for at in range(0, n, block):
            x = np.zeros((min(block, n - at), len(often)), np.float32)
            for r, i in enumerate(own[at:at + block]):
                found = place[rows[i]]
                x[r, found[found >= 0]] = 1
            both += x.T @ x
        p = np.diag(both) / n
        covariance.append(both / n - np.outer(p, p))
        share += p * n / len(y)
    spread = share * (1 - share)
    scale = np.sqrt(np.maximum(np.outer(spread, spread), 1e-12))
    apart = np.abs(covariance[0] - covariance[1]) / scale
    # In every text, in none, or two slots of the same texts (a short word is its own beginning): no pair.
    apart[scale < 1e-4] = 0
    apart[covariance[0] + covariance[1] > 1.98 * scale] = 0
    np.fill_diagonal(apart, 0)
    return often[apart.max(axis=1) >= max(effect, strength * np.sqrt(1 / sizes[0] + 1 / sizes[1]))]


def select(rows, y, most: int = 8192, strength: float = 4.0, often: int = 1024, pair_strength: float = 12.0,
           pair_effect: float = 0.4):
    """The slots whose frequency differs most between the classes, in standard errors; and of the `often`
    most frequent slots those that differ in pairs, such as two of which toxic texts have just one."""
    index = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    label = np.repeat(y, [len(r) for r in rows])
    toxic, clean = (np.bincount(index[label == k], minlength=SLOTS) for k in (1, 0))
    n1, n0 = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    p = (toxic + clean + 1) / (n1 + n0 + 2)
    z = np.abs(toxic / n1 - clean / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    z[toxic + clean < 5] = 0
    best = np.argsort(-z, kind="stable")[:most]
    frequent = np.argsort(-(toxic + clean), kind="stable")[:often]
    frequent = frequent[(toxic + clean)[frequent] >= 5]
    return np.union1d(best[z[best] >= strength], _by_pairs(rows, y, frequent, pair_strength, pair_effect))


def _score(x: Sparse, bias, w, v):
    """Scores and, for each factor, the sum of a row's vectors."""
    sums = [x.times(v[:, f]) for f in range(v.shape[1])]
    pairs = sum(s * s - x.times(np.square(v[:, f])) for f, s in enumerate(sums))
    return bias[0] + x.times(w) + 0.5 * pairs, sums


def fit(texts, y, factors: int = 4, steps: int = 300, rate: float = 0.05, ridge: float = 1e-4):
    """(selected slots, bias, weights, vectors)."""
    rows = [terms(t) for t in texts]
    y = np.clip(y, 0, 1)
    chosen = select(rows, y) if len(y) else np.zeros(0, np.int64)
    share = (y.sum() + 1) / (len(y) + 2)
    bias, w = np.array([np.log(share / (1 - share))]), np.zeros(len(chosen))
    v = np.random.default_rng(7).normal(0, 0.01, (len(chosen), factors))
    if len(chosen):
        x = Sparse([(np.searchsorted(chosen, own), np.ones(len(own)))
                    for own in (np.intersect1d(r, chosen, assume_unique=True) for r in rows)])
        adam = Adam(rate, 1, len(chosen), v.shape)
        for _ in range(steps):
            score, sums = _score(x, bias, w, v)
            g = (sigmoid(score) - y) / len(y)
            plain = x.back(g, len(chosen))
            by_v = np.stack([x.back(g * s, len(chosen)) - v[:, f] * plain for f, s in enumerate(sums)], axis=1)
            adam.step([bias, w, v], [g.sum(keepdims=True), plain + ridge * w, by_v + ridge * v])
    return chosen, bias, w, v


def toxicity(docs: DataFrame, labels: DataFrame, held_out, target=None, least: float = 0.7,
             train_rows: int = 20_000) -> DataFrame:
    """One row for each row of `docs`: doc_id, held_out, score (0 to 1), predicted (score >= least).

    The model is fitted on at most `train_rows` labelled documents for which the column `held_out`
    is not true; it sees their texts only. Null and empty texts get the score of no terms. Without
    labels or telling terms all texts get the same score. Repeated rows stay.
    """
    target = F.col("toxic") if target is None else target
    known = labels.filter(~F.coalesce(held_out, F.lit(False)))
    chosen, bias, w, v = fit_in_task(training_sample(docs, known, target, train_rows), fit)
    place = np.full(SLOTS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def rows(ids, held, texts):
        own = [place[terms(t)] for t in texts]
        score, _ = _score(Sparse([(i[i >= 0], np.ones((i >= 0).sum())) for i in own]), bias, w, v)
        score = sigmoid(score)
        yield ids, held, score, (score >= least).astype(np.int32)

    return map_rows(
        docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), as_bytes()), rows,
        "doc_id long, held_out boolean, score double, predicted int")

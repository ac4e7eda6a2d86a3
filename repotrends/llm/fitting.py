"""What the trained operators share: bounded training samples, fitting in one task, Adam."""

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def training_sample(docs: DataFrame, labels: DataFrame, target, rows: int) -> DataFrame:
    """`(text, y)` of at most `rows` labelled documents, chosen by a hash of doc_id.

    `target` is a column of `labels`. Null ids and targets are left out; of contradicting labels
    the smallest counts, of repeated documents each row.
    """
    known = labels.select("doc_id", target.cast("int").alias("y")).dropna().groupBy("doc_id").agg(
        F.min("y").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most `rows` ids: safe to broadcast.
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return (
        found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(rows)
        .select(F.col("text").cast("binary").alias("text"), "y")
    )


def fit_in_task(sample: DataFrame, fit):
    """Run `fit(texts, y)` over a bounded sample in one task and return its small model."""
    def run(batches):
        texts, y = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            y += batch.column("y").to_pylist()
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(fit(texts, np.array(y, int)))], pa.binary())})

    row = sample.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(row["model"]) if row else fit([], np.zeros(0, int))  # no task without rows


class Sparse:
    """Rows of (index, value), concatenated."""

    def __init__(self, rows):
        sizes = np.array([len(i) for i, _ in rows], np.int64)
        self.n = len(rows)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.index = np.concatenate([i for i, _ in rows] or [np.zeros(0, np.int64)]).astype(np.int64)
        self.value = np.concatenate([v for _, v in rows] or [np.zeros(0)]).astype(np.float64)

    def times(self, w):
        return np.bincount(self.row, self.value * w[self.index], self.n)

    def back(self, g, size):
        return np.bincount(self.index, self.value * g[self.row], size)


class Adam:
    """Full-batch steps; deterministic."""

    def __init__(self, rate, *shapes):
        self.rate, self.t = rate, 0
        self.m, self.v = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]

    def step(self, values, grads):
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for x, g, m, v in zip(values, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= rate * m / (np.sqrt(v) + 1e-8)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, np.float64)))

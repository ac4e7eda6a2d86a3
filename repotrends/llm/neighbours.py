"""Approximate nearest neighbours: a forest of random-projection trees.

The trees are fitted on a bounded sample; every vector is filed in one leaf of each tree. A query
walks all trees through one priority queue, the nearest splitting planes first, until it has named
enough leaves. Candidates of those leaves are ranked by exact distance. Leaves are searched in blocks,
so that neither the vectors nor the queries of one leaf have to fit in a task. How many leaves are
enough is measured in each run: some queries are compared with all vectors.
"""

import heapq
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import stored

SAMPLE = 1 << 16      # vectors that the trees are fitted on, at most
LEAST_IN_LEAF = 8     # sample vectors in a leaf, at least
PROBES = 256          # leaves that a query visits, at least
ASKED = 256           # queries whose neighbours are sought among all vectors, at most
RECALL = 0.95         # share of those neighbours that must be found: the contract's 0.9 and some for chance
BLOCK = 8192          # vectors, or queries, of a leaf that meet in one group, about


def _split(x: np.ndarray, rng, tries: int = 16, most: int = 2000):
    """Of some random directions between two of the vectors the one along which they spread most;
    the cut is where, between the quartiles, the two sides differ most."""
    some = x[rng.choice(len(x), most, replace=False)] if len(x) > most else x
    pairs = rng.integers(0, len(some), (tries, 2))
    planes = some[pairs[:, 0]] - some[pairs[:, 1]]
    planes = np.where(np.any(planes != 0, axis=1)[:, None], planes, rng.normal(size=planes.shape))
    planes /= np.sqrt(np.square(planes).sum(axis=1))[:, None]
    plane = planes[np.argmax((some @ planes.T).var(axis=0))]
    along = x @ plane
    ordered = np.sort(along)
    n = np.arange(1, len(ordered))
    sums = np.cumsum(ordered)
    apart = n * (len(ordered) - n) * np.square(sums[:-1] / n - (sums[-1] - sums[:-1]) / (len(ordered) - n))
    low, high = len(n) // 4, max(len(n) // 4 + 1, 3 * len(n) // 4)
    at = low + int(np.argmax(apart[low:high])) if len(n) else 0
    return plane, (ordered[at] + ordered[min(at + 1, len(ordered) - 1)]) / 2, along


def grow(sample: np.ndarray, rows: int, trees: int, leaf: int, seed: int):
    """Planes and cuts of the inner nodes of complete binary trees, (trees, nodes, dimensions) and
    (trees, nodes), so deep that `rows` vectors give leaves of about `leaf`, as far as the sample
    allows."""
    depth = 0
    while rows >> depth > leaf and len(sample) >> (depth + 1) >= LEAST_IN_LEAF:
        depth += 1
    inner, dim = (1 << depth) - 1, sample.shape[1] if sample.ndim == 2 else 0
    planes, cuts = np.zeros((trees, inner, dim)), np.zeros((trees, inner))
    rng = np.random.default_rng(seed)
    for t in range(trees):
        parts = {0: np.arange(len(sample))}
        for k in range(inner):
            own = parts.pop(k)
            right = np.zeros(len(own), bool)
            if len(own):
                planes[t, k], cuts[t, k], along = _split(sample[own], rng)
                right = along > cuts[t, k]
            parts[2 * k + 1], parts[2 * k + 2] = own[~right], own[right]
    return planes, cuts


class Forest:
    """Trees whose node k has children 2k + 1 and 2k + 2; the last level are leaves."""

    def __init__(self, planes: np.ndarray, cuts: np.ndarray):
        self.planes, self.cuts = planes, cuts
        self.inner = cuts.shape[1]
        self.depth = (self.inner + 1).bit_length() - 1

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of each row in each tree."""
        out = np.zeros((len(x), len(self.planes)), np.int64)
        for t in range(len(self.planes)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", x, self.planes[t, at]) > self.cuts[t, at]
                at = 2 * at + 1 + right
            out[:, t] = at - self.inner
        return out

    def search(self, q: np.ndarray, most: int) -> list[tuple[int, int]]:
        """The `most` leaves (tree, leaf) that come first out of a queue shared by all trees."""
        margins = self.planes @ q - self.cuts
        queue = [(0.0, t, 0) for t in range(len(self.planes))]
        out = []
        while queue and len(out) < most:
            far, t, k = heapq.heappop(queue)
            while k < self.inner:
                m = margins[t, k]
                near = 2 * k + 1 + int(m > 0)
                heapq.heappush(queue, (max(far, abs(m)), t, 4 * k + 3 - near))
                k = near
            out.append((t, k - self.inner))
        return out


def distances(x, point):
    """Euclidean distances of rows to a point. Where squares leave the range of a double, differences are
    scaled by the largest before they are squared."""
    with np.errstate(over="ignore", under="ignore"):
        apart = x - point
        out = np.sqrt(np.square(apart).sum(axis=1))
    odd = np.flatnonzero(~np.isfinite(out) | (out < 1e-150))
    if len(odd):
        most = np.abs(apart[odd]).max(axis=1, initial=0)
        scale = np.where((most > 0) & np.isfinite(most), most, 1)
        with np.errstate(over="ignore"):
            out[odd] = scale * np.sqrt(np.square(apart[odd] / scale[:, None]).sum(axis=1))
    return out


def _usable(vectors: DataFrame, embedding: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    v = F.col("vector")
    return vectors.select("vec_id", F.col(embedding).cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vector", lambda x: x != 0))


def nearest(vectors: DataFrame, is_query, k: int = 10, embedding: str = "embedding", trees: int = 4,
            leaf: int = 256, probes: int | None = None, seed: int = 11) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k nearest found, nearest first, ties to
    the smaller vec_id. score is the Euclidean distance in double precision.

    `is_query` is a column; candidates are all rows but those with the query's vec_id. Vectors that
    are null, zero, hold null or non-finite components or have another length than most take no
    part. Of equal vectors only the k + 1 smallest ids can be among any k nearest, so only they are
    filed. `probes` leaves are searched for each query; if it is None, so many that RECALL of the
    neighbours of some queries are found (see `enough`), up to all leaves.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors, embedding)
    lengths = usable.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    dim = lengths.orderBy(F.desc("rows"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if dim is None:
        return spark.createDataFrame([], schema)
    flagged = vectors.filter(is_query).select("vec_id")
    usable = usable.filter(F.size("vector") == dim["n"])
    # Equal vectors meet in one window; each task passes on its k + 1 smallest ids only.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    some = stored(usable.withColumn("place", place).filter(F.col("place") <= k + 1), "vectors")
    single = some.filter("place = 1").groupBy("vector").agg(F.min("vec_id").alias("first_id"))
    size = some.filter("place = 1").count()
    sample = some.filter("place = 1").orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(SAMPLE)
    forest = _fit(sample, size, trees, leaf, seed)
    queries = usable.join(flagged.distinct(), "vec_id", "left_semi").dropDuplicates(["vec_id", "vector"])

    if probes is None:
        probes = enough(some, queries, forest, k, seed)

    def file(batches):
        for b in batches:
            x = np.array(b.column(1).to_pylist(), np.float64).reshape(b.num_rows, -1)
            at = forest.leaves(x)
            n = at.shape[1]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.tile(np.arange(n), len(x)), pa.int32()), pa.array(at.ravel(), pa.int64()),
                pa.array(np.repeat(np.array(b.column(0).to_pylist(), np.int64), n), pa.int64()),
                b.column(1).take(pa.array(np.repeat(np.arange(len(x)), n)))],
                names=["tree", "leaf", "vec_id", "vector"])

    def walk(batches):
        for b in batches:
            out = {"tree": [], "leaf": [], "query_id": [], "of": []}
            for n, (i, v) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                for t, at in forest.search(np.array(v), probes):
                    for column, value in zip(out.values(), (t, at, i, n)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([
                pa.array(out["tree"], pa.int32()), pa.array(out["leaf"], pa.int64()),
                pa.array(out["query_id"], pa.int64()), b.column(1).take(pa.array(out["of"], pa.int64()))],
                names=["tree", "leaf", "query_id", "vector"])

    def rank(key, found, asked):
        out = []
        if len(found) and len(asked):
            x, ids = np.stack(found["vector"]), found["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            x, ids = x[order], ids[order]
            for q, v in zip(asked["query_id"], asked["vector"]):
                others = np.flatnonzero(ids != q)
                score = distances(x[others], v)
                out += [(q, int(ids[others[n]]), float(score[n])) for n in np.argsort(score, kind="stable")[:k + 1]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    # Filing is cheap, so it is done once to count and once to deal, and only the latter is shuffled.
    filed = some.select("vec_id", "vector").mapInArrow(file, "tree int, leaf long, vec_id long, vector array<double>")
    walked = stored(queries.select("vec_id", "vector").mapInArrow(
        walk, "tree int, leaf long, query_id long, vector array<double>"), "walked")

    def blocks(df, name):
        return df.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias(name))

    def dealt(df, own, own_id, others):
        """Every row in one block of its own side, and once for each block of the other side."""
        return df.join(F.broadcast(leaves), ["tree", "leaf"]).select(
            *df.columns, F.pmod(F.xxhash64(own_id), own).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1)).alias(others))

    # One row for each leaf that a query visits: at most trees * SAMPLE / LEAST_IN_LEAF.
    leaves = stored(blocks(filed, "rows").join(blocks(walked, "asked"), ["tree", "leaf"]), "leaves")
    key = ["tree", "leaf", "rows", "asked"]
    near = dealt(filed, "rows", "vec_id", "asked").groupBy(*key).cogroup(
        dealt(walked, "asked", "query_id", "rows").groupBy(*key)).applyInPandas(
        rank, "query_id long, vec_id long, score double")
    best = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def enough(some: DataFrame, queries: DataFrame, forest: Forest, k: int, seed: int) -> int:
    """Leaves that queries have to visit, PROBES at least. ASKED queries, chosen by hash, are compared
    with all vectors; for each neighbour it is known at which leaf of its query's queue it is found."""
    leaves = len(forest.planes) * (forest.inner + 1)
    if leaves <= PROBES:
        return leaves
    asked = queries.orderBy(F.xxhash64("vec_id", F.lit(seed + 1)), "vec_id", "vector").limit(ASKED).collect()
    ids = np.array([r["vec_id"] for r in asked], np.int64)
    points = np.array([r["vector"] for r in asked], np.float64)

    def compare(batches):
        for b in batches:
            x = np.array(b.column(1).to_pylist(), np.float64).reshape(b.num_rows, -1)
            own = np.array(b.column(0).to_pylist(), np.int64)
            order = np.argsort(own, kind="stable")
            x, own = x[order], own[order]
            at, of, far = [], [], []
            for n, q in enumerate(points):
                others = np.flatnonzero(own != ids[n])
                score = distances(x[others], q)
                best = np.argsort(score, kind="stable")[:k]
                at.append(others[best])
                of.append(np.full(len(best), n))
                far.append(score[best])
            at = np.concatenate(at) if at else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(of), pa.int32()), pa.array(own[at], pa.int64()),
                pa.array(np.concatenate(far), pa.float64()), b.column(1).take(pa.array(order[at]))],
                names=["of", "vec_id", "score", "vector"])

    def visits(batches):
        queues = {}
        for b in batches:
            filed = forest.leaves(np.array(b.column(1).to_pylist(), np.float64).reshape(b.num_rows, -1))
            out = []
            for n, own in zip(b.column(0).to_pylist(), filed):
                if n not in queues:
                    queues = {n: {leaf: i for i, leaf in enumerate(forest.search(points[n], leaves), 1)}}
                out.append(min(queues[n][t, int(at)] for t, at in enumerate(own)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["visits"])

    order = Window.partitionBy("of").orderBy("score", "vec_id")
    near = some.select("vec_id", "vector").mapInArrow(
        compare, "of int, vec_id long, score double, vector array<double>").withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    found = np.sort([r["visits"] for r in near.select("of", "vector").mapInArrow(visits, "visits long").collect()])
    return max(PROBES, int(found[int(np.ceil(RECALL * len(found))) - 1])) if len(found) else PROBES


def _fit(sample: DataFrame, rows: int, trees: int, leaf: int, seed: int) -> Forest:
    def run(batches):
        parts = [np.array(b.column(0).to_pylist(), np.float64).reshape(b.num_rows, -1) for b in batches]
        x = np.concatenate(parts) if parts else np.zeros((0, 0))
        yield pa.RecordBatch.from_pydict({"model": pa.array(
            [pickle.dumps(grow(x, rows, trees, leaf, seed))], pa.binary())})

    return Forest(*pickle.loads(
        sample.select("vector").repartition(1).mapInArrow(run, "model binary").first()["model"]))

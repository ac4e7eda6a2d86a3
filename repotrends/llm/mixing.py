"""Mixing overlapping sources to target weights by min-cost flow.

Documents are added up by membership pattern: the sources that they belong to. A flow routes the
patterns' words to the sources' quotas; the second and third use of the same words cost more and
more, so repetition is spread as evenly as the quotas allow. Documents are then chosen by seeded
hash until their pattern's flow is used up.
"""

import heapq

from pyspark.sql import DataFrame, Window, functions as F

from .common import as_bytes, fresh, map_rows, stored

BUCKET = 1000


def targets(sizes: dict, weights=(5, 2, 1), most: int = 3, total: float | None = None) -> dict:
    """Words that each source shall give. `sizes` is by source name; None is the name of no source.

    Sources in code-point order, None last, take the weights in turn and share `total` (by default
    all sizes) in their proportion. None gets over `most` times its size: what is over is shared
    among the others until none is above.
    """
    names = sorted((s for s in sizes if s is not None), key=str) + [s for s in sizes if s is None]
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    left = float(sum(sizes.values()) if total is None else total)
    out, open_ = {}, names
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * share > most * sizes[s]]
        if not over:
            return {**out, **{s: weight[s] * share for s in open_}}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def flow(patterns: dict, quotas: dict, most: int = 3) -> dict:
    """Words taken of each pattern, by min-cost flow (successive shortest paths).

    `patterns` maps a tuple of sources to its words, `quotas` a source to its whole words. Using a
    pattern's words for the k-th time costs k - 1 a word.
    """
    start, end, number = 0, 1, {}
    head, room, cost, out = [], [], [], [[], []]

    def node(name):
        if name not in number:
            number[name] = len(out)
            out.append([])
        return number[name]

    def arc(a, b, size, price):
        for x, y, s, p in ((a, b, size, price), (b, a, 0, -price)):
            out[x].append(len(head))
            head.append(y), room.append(s), cost.append(p)

    first = {}
    for pattern, words in patterns.items():
        first[pattern] = len(head)
        for use in range(most):
            arc(start, node(("pattern", pattern)), words, use)
        for source in pattern:
            arc(node(("pattern", pattern)), node(("source", source)), most * words, 0)
    for source, quota in quotas.items():
        arc(node(("source", source)), end, quota, 0)
    potential = [0] * len(out)
    while True:
        far, via, queue = {start: 0}, {}, [(0, start)]
        done = set()
        while queue:
            d, a = heapq.heappop(queue)
            if a in done:
                continue
            done.add(a)
            for e in out[a]:
                if room[e] > 0 and (new := d + cost[e] + potential[a] - potential[head[e]]) < far.get(head[e], 1 << 60):
                    far[head[e]], via[head[e]] = new, e
                    heapq.heappush(queue, (new, head[e]))
        if end not in far:
            break
        reach = far[end]
        potential = [p + min(far.get(n, reach), reach) for n, p in enumerate(potential)]
        path, at = [], end
        while at != start:
            path.append(via[at])
            at = head[via[at] ^ 1]
        moved = min(room[e] for e in path)
        for e in path:
            room[e] -= moved
            room[e ^ 1] += moved
    return {p: sum(room[e + 2 * use + 1] for use in range(most)) for p, e in first.items()}


def _sized(docs: DataFrame) -> DataFrame:
    """doc_id, members, size in words, and a hash of the text, for each row."""
    def rows(ids, members, tags, texts):
        yield ids, members, tags, [len(t.split()) for t in texts]

    return map_rows(
        docs.select("doc_id", "members", F.xxhash64("text").alias("tag"), as_bytes()), rows,
        "doc_id long, members array<string>, tag long, size long")


def _row_keys(pattern):
    return F.xxhash64("doc_id", pattern, "tag"), F.hash(F.col("doc_id").isNull(), F.col("tag"))


def _marked(dealt: DataFrame, more) -> DataFrame:
    return dealt.select("pattern", "k1", "k2", "h", "size", "whole", "rest", more.alias("more"))


def _prefix(dealt: DataFrame, allowance) -> DataFrame:
    """Mark, of each pattern, the first rows by (bucket, hash) whose words together are within the
    allowance. Buckets are added up first, so a large pattern's rows are never one task."""
    buckets = dealt.groupBy("pattern", "bucket").agg(F.sum("size").alias("words"))
    earlier = buckets.select("pattern", "bucket", F.coalesce(F.sum("words").over(
        Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("earlier"))
    inside = F.sum("size").over(Window.partitionBy("pattern", "bucket").orderBy("h", "k1", "k2").rowsBetween(
        Window.unboundedPreceding, 0))
    joined = dealt.withColumn("inside", inside).join(earlier, ["pattern", "bucket"])
    return _marked(joined, F.col("earlier") + F.col("inside") <= allowance)


def _decisions(spark, sized: DataFrame, weights, most: int, seed: int):
    """Copies to take of each different row (k1, k2), and the sources' sizes and targets."""
    pattern = F.to_json(F.array_sort(F.array_distinct("members")), {"ignoreNullFields": "false"})
    k1, k2 = _row_keys("pattern")
    keyed = sized.withColumn("pattern", pattern).select(
        "*", k1.alias("k1"), k2.alias("k2"))
    # Repeated rows are decided as one, by their words together.
    rows = stored(keyed.groupBy("pattern", "k1", "k2").agg(
        F.first("members").alias("members"), F.sum("size").alias("size")), "mix-rows")
    # One row for each combination of sources that occurs: a catalogue, not data.
    found = rows.groupBy("pattern").agg(
        F.first("members").alias("members"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    names = {r["pattern"]: tuple(dict.fromkeys(r["members"])) for r in found}
    sizes = {}
    for r in found:
        for source in names[r["pattern"]]:
            sizes[source] = sizes.get(source, 0) + r["size"]
    total = sum(r["size"] for r in found)
    goal = targets(sizes, weights, most, total)
    taken = flow({names[r["pattern"]]: r["size"] for r in found}, {s: round(t) for s, t in goal.items()}, most)
    parts = [(r["pattern"], *(divmod(taken[names[r["pattern"]]], r["size"]) if r["size"] else (0, 0)),
              max(1, -(-r["n"] // BUCKET))) for r in found]
    shares = spark.createDataFrame(parts, "pattern string, whole long, rest long, buckets long")
    order = F.xxhash64("k1", "k2", F.lit(seed))
    # Tables by pattern are as short as the catalogue above, so they may be broadcast.
    dealt = rows.join(F.broadcast(shares), "pattern").withColumn("h", order).withColumn(
        "bucket", F.pmod(F.shiftrightunsigned("h", 16), F.col("buckets")))
    # Rows over a twentieth of the rest come first, so that small rows can fill what they leave.
    size, rest = F.col("size"), F.col("rest")
    large = stored(_prefix(dealt.filter((size * 20 > rest) & (size <= rest)), rest), "mix-large")
    used = large.filter("more").groupBy("pattern").agg(F.sum("size").alias("used"))
    small = dealt.filter(size * 20 <= rest).join(F.broadcast(used), "pattern", "left")
    chosen = stored(
        large.union(_prefix(small, rest - F.coalesce("used", F.lit(0))))
        .union(_marked(dealt.filter(size > rest), F.lit(False))), "mix-choice")
    # What is left of the rest goes to the row that comes nearest to it, if that is nearer than none.
    gaps = chosen.groupBy("pattern").agg(F.max("rest").alias("rest"), F.coalesce(
        F.sum(F.when(F.col("more"), F.col("size"))), F.lit(0)).alias("words")).select(
        "pattern", (F.col("rest") - F.col("words")).alias("gap"))
    last = chosen.filter(~F.col("more") & (F.col("size") > 0)).join(F.broadcast(gaps), "pattern").filter(
        F.col("size") < 2 * F.col("gap")).groupBy("pattern").agg(
        F.min(F.struct(F.abs(F.col("gap") - F.col("size")), "size", "h", "k1", "k2")).alias("last")).select(
        F.col("pattern").alias("p"), F.col("last.k1").alias("l1"), F.col("last.k2").alias("l2"))
    copies = chosen.join(
        last, (F.col("pattern") == F.col("p")) & (F.col("k1") == F.col("l1")) & (F.col("k2") == F.col("l2")), "left"
    ).select("k1", "k2", F.least(F.lit(most), F.col("whole") + F.when(
        F.col("more") | F.col("p").isNotNull(), 1).otherwise(0)).alias("copies"))
    return keyed, copies, sizes, goal


def mix(docs: DataFrame, members=None, weights=(5, 2, 1), most: int = 3, seed: int = 1) -> DataFrame:
    """One row for each row of `docs`: doc_id, size, source_size, target, taken.

    `members` is a column of `docs` with the names of the sources that a document belongs to, by
    default its `source` alone; a null is a source of its own. size counts words (runs of other
    than ASCII white space; null and empty texts: 0). source_size and target are added up over the
    document's sources. taken is size times the copies that the mix takes, at most `most`; whole
    documents are taken, the last one where its source comes nearer to its target with it than without.
    Empty documents are taken at most `most` times as well. Rows that repeat doc_id, text and sources are decided as one. Reruns agree. Other columns are not read.
    """
    spark = docs.sparkSession
    members = F.array("source") if members is None else members
    sized = stored(_sized(docs.select("doc_id", "text", members.alias("members"))), "sizes")
    keyed, copies, sizes, goal = _decisions(spark, sized, weights, most, seed)
    catalogue = spark.createDataFrame(
        [(s, sizes[s], goal[s]) for s in sizes], "name string, own_size long, own_target double")
    names = keyed.select("pattern", "members").groupBy("pattern").agg(F.first("members").alias("members"))
    sums = names.select("pattern", F.explode("members").alias("member")).join(
        F.broadcast(catalogue), F.col("member").eqNullSafe(F.col("name"))).groupBy("pattern").agg(
        F.sum("own_size").alias("source_size"), F.sum("own_target").alias("target"))
    return keyed.join(copies, ["k1", "k2"]).join(F.broadcast(sums), "pattern").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def take_mix(docs: DataFrame, members=None, weights=(5, 2, 1), most: int = 3, seed: int = 1) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it takes it."""
    spark = docs.sparkSession
    members = F.array("source") if members is None else members
    sized = stored(_sized(docs.select("doc_id", "text", members.alias("members"))), "sizes")
    _, copies, _, _ = _decisions(spark, sized, weights, most, seed)
    pattern, tag, k1, k2, times = fresh(docs, "pattern", "tag", "k1", "k2", "copies")
    own = docs.withColumn(pattern, F.to_json(
        F.array_sort(F.array_distinct(members)), {"ignoreNullFields": "false"})).withColumn(tag, F.xxhash64("text"))
    own = own.withColumn(k1, F.xxhash64("doc_id", pattern, tag)).withColumn(
        k2, F.hash(F.col("doc_id").isNull(), F.col(tag)))
    taken = own.join(copies.toDF(k1, k2, times), [k1, k2]).filter(F.col(times) > 0)
    return taken.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)

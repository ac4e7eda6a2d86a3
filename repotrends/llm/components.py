"""Connected components by alternating large-star and small-star rounds."""

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.join(least, "a").filter("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from larger to smaller: link a node and its smaller neighbours to the least."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).union(rest).distinct()


def _print(edges: DataFrame):
    """Size and order-free checksum of an edge set."""
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))
    ).first()


def components(edges: DataFrame) -> DataFrame:
    """`(node, root)` for each node of an edge: root is the smallest node of its component.

    `edges` has two columns of one orderable type. A round moves as many rows as there are
    edges, no node's neighbours meet in one task, and the number of rounds grows with the
    logarithm of the longest path. Each round is written to the shared scratch folder.
    """
    a, b = edges.columns
    now = stored(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter("a <> b").distinct(), "edges")
    seen = _print(now)
    while seen[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        before, seen = seen, _print(now)
        if before == seen:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)

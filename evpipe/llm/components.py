"""Connected components of a large graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evpipe.llm.util import stage
from evpipe.plans.staging import new_path, remove_path


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` for every node of the edges `a`, `b` that is not its component's smallest.

    Every round points nodes to the smallest node they know of, first the larger neighbours of each
    node, then the smaller ones. Minima are aggregated before their shuffle, so a node with very
    many neighbours is no hot group; the joins that carry them are left to skew handling. Rounds
    are logarithmic in the size of a component. Each is written to the shared folder, from where the
    round before is then removed. The last round changes nothing, told by the number of edges and
    two sums of their 64-bit hashes.
    """
    spark = edges.sparkSession
    path = new_path(spark, "edges")
    edges = stage(edges.filter("a <> b").select("a", "b"), "edges", path)
    before = None
    while True:
        read, path = path, new_path(spark, "stars")
        edges = stage(_small_star(_large_star(edges)), "stars", path)
        remove_path(spark, read)
        state = edges.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
            F.sum(F.xxhash64("b", "a", F.lit(1)).cast("decimal(38,0)")).alias("t"),
        ).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    told = both.filter("b > a").join(least, F.col("a") == F.col("c"))
    return told.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    told = down.join(least.select(F.col("a").alias("c"), "m"), F.col("a") == F.col("c"))
    sides = told.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    own = least.select("a", F.col("m").alias("b"))
    return sides.unionByName(own).distinct()

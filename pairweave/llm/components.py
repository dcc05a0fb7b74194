"""Connected components of a graph given by edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairweave.session import remove, rewrite


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges`` (``a, b``, any ordered type): ``root`` is the least node it is connected with.

    Each round joins every node's neighbours with the least of them; the minimum is taken with map-side combine and the
    join splits a node with many neighbours. Rounds grow with the logarithm of the longest path. A round is written to the
    shared folder and the one before it removed.
    """
    spark = edges.sparkSession
    pairs, path = rewrite(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lowest, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.withColumnRenamed("m", "b"))
        pairs, new = rewrite(small.distinct(), "edges")
        remove(spark, path)
        path = new
        seen = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == state:
            break
        state = seen
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

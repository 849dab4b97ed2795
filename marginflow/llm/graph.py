"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import write_table

MAX_ROUNDS = 64


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root: the least node.

    Alternates large-star and small-star steps until the edge set no longer
    changes; it is then a star around each component's least node.  Minima
    are aggregated map-side, and each join has two plain shuffled sides, so
    that a hub's edges can be split over tasks.  Every step is written to the
    shared folder.
    """
    e = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = write_table(e, "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        now = e.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = write_table(both.groupBy("u").agg(F.min("v").alias("m"))
                            .select("u", F.least("u", "m").alias("m")), "least")
        large = write_table(both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                            .distinct(), "large-star")
        least = write_table(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = write_table(small.unionByName(least.select("a", F.col("m").alias("b")))
                        .filter("a != b")
                        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                        "small-star")
    else:
        raise RuntimeError(f"components have not settled after {MAX_ROUNDS} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")) \
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

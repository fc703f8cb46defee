"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014).

Every round is two partially aggregated minimums and two equi-joins, so a node with any
number of neighbours never has them gathered in one task.  The number of rounds grows with
the logarithm of the longest path.  Each round is written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.plans.scratch import staged


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    pairs = F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return large.join(low, "a").select(F.inline(pairs)).where("a <> b").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an undirected edge list; component is its smallest node.

    Null ends and self-loops are ignored; no edges give no rows.
    """
    a, b = F.col(src), F.col(dst)
    now = staged(edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    for _ in range(max_rounds):
        seen = now.select(F.col("a").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(now.select("b", F.lit(0), F.lit(1)))
        knots = seen.groupBy("n").agg(F.sum("child").alias("child"), F.max("root").alias("root")).where("child > 1 OR (child > 0 AND root > 0)")
        if not knots.take(1):
            break
        now = staged(_round(now), "edges")
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())

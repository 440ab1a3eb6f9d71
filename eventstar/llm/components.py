"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstar.llm.common import materialize


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root: the smallest node of each node's component.

    ``edges`` has two bigint columns ``a`` and ``b``.  Each round links the
    larger neighbours of a node, then its smaller ones, to the smallest node
    around it; the edges end as stars.  Rounds grow with the logarithm of the
    longest path; each is written, so lost executors cost one round at most.
    Nodes with many edges are pre-aggregated (min) and their join is split by
    AQE.  Null nodes and loops are ignored.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .filter("a <> b").distinct(), "edges")

    def size(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                     .first())

    seen = size(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(
            "a", F.least("a", "low").alias("low"))
        large = (both.join(least, "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .filter("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(low, "a").select(F.col("b").alias("x"), "low")
                 .unionByName(low.select(F.col("a").alias("x"), "low"))
                 .filter("x <> low")
                 .select(F.col("x").alias("a"), F.col("low").alias("b")).distinct())
        now = materialize(small, "edges")
        found = size(now)
        if found == seen:
            break
        seen = found
    else:
        raise RuntimeError(f"components not found in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()

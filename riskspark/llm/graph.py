"""Connected components over link tables by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import materialize

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); root is the smallest node of the component.

    Every round hangs each node's larger neighbours, then its smaller ones, on
    the smallest neighbour (minimum per node with partial aggregation, one join
    back); each round's edges are written to the shared folder.  The rounds end
    when the edges no longer change.
    """
    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    state = None
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(low.filter("u > m").select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = small.union(low.select("u", F.col("m").alias("v"))).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        edges = materialize(small, "cc")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not converge")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", F.col("v").alias("root")))

"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialise

#: Far beyond what the steps need; they shrink any path by a constant factor.
MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a, b``, long) that is not its component's least; ``root`` is the least.

    Minima combine before the shuffle and the joins split hot nodes, so a node of many edges is no
    hot key. Each round is written to the shared folder, which ends its lineage.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = None
    for _ in range(MAX_ROUNDS):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        stats = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if stats == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = stats
    raise RuntimeError("the components did not settle")

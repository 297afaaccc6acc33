"""Connected components of a link table, by distributed star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._work import Workspace


def connected_components(links: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """(node, component) of each node in ``links`` (columns a, b); component is the smallest node reachable.

    Alternates two steps until nothing changes: every node hangs its larger
    neighbours under its smallest one, then its smaller neighbours and itself.
    All work is aggregation and joins on the link table, a few rounds for any
    shape; only a count and a checksum come to the driver. Null ends and loops
    are ignored; an empty table gives no rows.
    """
    edges = work.keep(
        links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0"
    )
    state, turn = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        larger = both.filter("v > u").join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = work.keep(larger, f"{name}-large-{turn}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        smaller = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        after = work.keep(smaller, f"{name}-{turn + 1}")
        now = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        edges, turn = after, turn + 1
        if now == state:
            break
        state = now
    own = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own.select("node", F.col("node").alias("component")))

"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpscope.llm import common as U

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node points its larger (large) or smaller (small) neighbours at its minimum."""
    if large:
        arcs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        arcs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = arcs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    both = arcs.join(low, "u")
    if large:
        out = both.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = both.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node of ``links`` (two long columns); the root is the smallest
    node that can be reached.  Each round is stored; the driver sees one count and one sum."""
    edges = U.stored(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        edges = U.stored(_star(_star(edges, True), False), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if state == before or state[0] == 0:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

"""Co-occurrence pairs inside groups, without letting a hot group sink one task.

The output of a co-occurrence graph *is* the set of item pairs per group, so the
work is Σ k(k-1)/2 rows and cannot be avoided.  What can be avoided is doing all
of one big group's pairs in one task:

* small groups given as arrays (≤ ``inline_max`` distinct items) make their
  pairs in-row with higher-order functions — no shuffle before the final
  aggregation;
* larger groups are exploded to ``(group, item)`` rows and paired by a
  self-join on the group key (one shuffle, re-used for both sides);
* groups with more than ``hot_items`` rows are *hot*: their distinct items are
  hashed into B blocks and every block pair (i ≤ j) becomes its own join key,
  so one hot group is spread over B(B+1)/2 tasks of ~``hot_items``² pairs.

No group is capped, sampled or truncated: every pair is produced exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpscope.functions import text as TX

# number of hot groups below which their key list is broadcast (a proven bound)
HOT_KEYS_BROADCAST_MAX = 100_000
# rows and pairs of one task of the self-join (a group is never cut)
PAIRS_PER_PART = 500_000


def array_pairs(df: DataFrame, group: str, arr: str, inline_max: int = 64,
                hot_items: int = 4096) -> DataFrame:
    """``(u, v)`` once per row and unordered distinct pair ``u < v`` of ``arr``.

    ``group`` must identify the row (e.g. the post id).  The tier of a row is a
    row-level predicate on the array size, so no extra pass over the data is needed.
    """
    t = (df.select(F.col(group).alias("_g"), TX.distinct_sorted(arr).alias("_items"))
         .where(F.size("_items") >= 2))
    # the three tiers read one compact (group, items) table: the source (e.g. the
    # regex pass over every text) runs once, not once per tier
    t = t.checkpoint(eager=True)
    small = (t.where(F.size("_items") <= inline_max)
             .select(F.explode(TX.array_pairs("_items")).alias("_p"))
             .select(F.col("_p.u").alias("u"), F.col("_p.v").alias("v")))
    mid = (t.where((F.size("_items") > inline_max) & (F.size("_items") <= hot_items))
           .select("_g", F.explode("_items").alias("_i")))
    hot = (t.where(F.size("_items") > hot_items)
           .select("_g", F.size("_items").alias("_n"), F.explode("_items").alias("_i")))
    return (small.unionByName(_join_pairs(mid, distinct_done=True))
            .unionByName(_blocked_pairs(hot, hot_items, distinct_done=True)))


def row_pairs(rows: DataFrame, group: str, item: str, hot_items: int = 4096,
              distinct_done: bool = False) -> DataFrame:
    """``(u, v)`` once per group and unordered distinct pair of items (``u < v``)."""
    items = rows.select(F.col(group).alias("_g"), F.col(item).alias("_i")).where(F.col("_i").isNotNull())
    sizes = items.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.where(F.col("_n") > F.lit(hot_items))
    n, few = F.col("_n").cast("double"), F.col("_n") <= hot_items
    n_hot, work = sizes.agg(F.count_if(~few), F.sum(F.when(few, n + n * (n - 1) / 2))).first()
    n_parts = int((work or 0) // PAIRS_PER_PART) + 1
    if n_hot == 0:
        return _join_pairs(items, distinct_done, n_parts)
    hot_b = F.broadcast(hot) if n_hot <= HOT_KEYS_BROADCAST_MAX else hot
    normal = items.join(hot_b.select("_g"), "_g", "left_anti")
    hot_items_df = items.join(hot_b, "_g", "inner")
    return _join_pairs(normal, distinct_done, n_parts).unionByName(_blocked_pairs(hot_items_df, hot_items))


def _join_pairs(items: DataFrame, distinct_done: bool, n_parts: int | None = None) -> DataFrame:
    """``n_parts``: partitions, as many at any setting; else the session's number, which AQE may lessen."""
    base = items.repartition("_g") if n_parts is None else items.repartition(n_parts, "_g")
    if not distinct_done:
        base = base.dropDuplicates(["_g", "_i"])
    a = base.select("_g", F.col("_i").alias("u"))
    b = base.select("_g", F.col("_i").alias("v"))
    return a.join(b, "_g").where(F.col("u") < F.col("v")).select("u", "v")


def _blocked_pairs(items: DataFrame, hot_items: int, distinct_done: bool = False) -> DataFrame:
    """Pairs of hot groups: items hashed into B = ceil(n / hot_items) blocks per group;
    block pair (i, j), i ≤ j, is one join key.  Item in block b plays the left role for
    keys (b, j ≥ b) and the right role for keys (i ≤ b, b)."""
    # de-duplicated by (group, item): that shuffle spreads a hot group over all tasks
    d = items if distinct_done else items.dropDuplicates(["_g", "_i"])
    nb = F.greatest(F.ceil(F.col("_n") / F.lit(hot_items)), F.lit(1)).cast("int")
    # (column names are case-insensitive: keep block count and block id distinct)
    d = d.withColumn("_nblk", nb).withColumn("_blk", F.pmod(F.xxhash64("_i"), F.col("_nblk")).cast("int"))
    left = d.select("_g", F.col("_blk").alias("_bi"),
                    F.explode(F.sequence(F.col("_blk"), F.col("_nblk") - 1)).alias("_bj"),
                    F.col("_i").alias("x"))
    right = d.select("_g", F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_bi"),
                     F.col("_blk").alias("_bj"), F.col("_i").alias("y"))
    j = left.join(right, ["_g", "_bi", "_bj"])
    j = j.where((F.col("_bi") != F.col("_bj")) | (F.col("x") < F.col("y")))
    return j.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))

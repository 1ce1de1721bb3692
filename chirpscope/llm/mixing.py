"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, target / source size.  The
whole part is taken outright; the fractional parts are rounded together.  Two documents at a time
move *words* from one to the other - one's probability rises by ``a``, the other's falls by
``a * size / other size`` - until one of the two is 0 or 1; of the two possible directions one is
drawn so that no expectation changes.  The words expected in total never change, so a source ends
within one document of its target.

Distributed: units are dealt by hash into groups of about ``group`` rows within a source (a
source of any size has as many groups as it needs); each group leaves at most one fractional
unit, and the residuals of ``fanout`` groups meet in one group of the next level, until one per
source is left, which is rounded by its own probability.  Draws are seeded by source, group and
level: reruns over the same rows agree, whatever the partitioning.

Equal rows (all columns equal) are counted before they are dealt, so a row repeated any number of
times is one unit.  Sizes are the runs of ``[^\\x20\\x09-\\x0D]``.

Cases: null text has size 0; a null source is a source of its own, ordered last; size-0 documents
take nothing; an empty table gives an empty result.  The list of sources is the mix's
configuration and is held by the driver: more than ``MAX_SOURCES`` raise an error.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpscope.llm import common as U

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = 17
GROUP = 2048
FANOUT = 64
MAX_SOURCES = 1_000_000

UNIT = "sid int, grp long, ord long, key long, size long, p double, taken int, open boolean"


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> list[float]:
    """Target words of each source: ``share`` of all words by weight (the weights repeat), none
    above ``cap`` times its size; what is cut off is shared by weight among the others."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    left, free = share * sum(sizes), list(range(len(sizes)))
    while free:
        total = sum(w[i] for i in free)
        full = [i for i in free if left * w[i] / total > cap * sizes[i]]
        if not full:
            for i in free:
                out[i] = left * w[i] / total
            break
        for i in full:
            out[i] = cap * sizes[i]
        left -= sum(out[i] for i in full)
        free = [i for i in free if i not in set(full)]
    return out


def pivot(p: np.ndarray, size: np.ndarray, draw: np.ndarray, last: bool) -> tuple[np.ndarray, int]:
    """Round the probabilities; the place of the unit left fractional, or -1."""
    p = p.tolist()
    size, draw = size.tolist(), draw.tolist()
    held = -1
    for i, u in enumerate(draw[:len(p)]):
        if p[i] <= 0.0 or p[i] >= 1.0:
            continue
        if held < 0:
            held = i
            continue
        ratio = size[held] / size[i]
        up = min(1.0 - p[held], p[i] / ratio)                 # held rises, i falls
        down = min(p[held], (1.0 - p[i]) / ratio)             # held falls, i rises
        if u * (up + down) < down:
            whole = 1.0 - p[held] <= p[i] / ratio
            p[i] -= up * ratio
            p[held] += up
            done, value = (held, 1.0) if whole else (i, 0.0)
        else:
            whole = p[held] <= (1.0 - p[i]) / ratio
            p[i] += down * ratio
            p[held] -= down
            done, value = (held, 0.0) if whole else (i, 1.0)
        p[done] = value
        held = i if done == held else held
        if p[held] < 1e-12 or p[held] > 1 - 1e-12:
            p[held] = float(round(p[held]))
            held = -1
    if held >= 0 and last:
        p[held] = float(draw[-1] < p[held])
        held = -1
    return np.array(p), held


def _round(units: DataFrame, level: int, seed: int, last: bool) -> DataFrame:
    def group(t: pa.Table) -> pa.Table:
        # large ones first: the small ones that follow use up their fractions, so what is left is small
        t = t.sort_by([("size", "descending"), ("ord", "ascending"), ("key", "ascending")])
        rng = np.random.default_rng([seed, level, t["sid"][0].as_py(), t["grp"][0].as_py()])
        p, held = pivot(t["p"].to_numpy(), t["size"].to_numpy(), rng.random(t.num_rows + 1), last)
        open_ = np.zeros(len(p), bool)
        if held >= 0:
            open_[held] = True
        k = t.schema.get_field_index
        return (t.set_column(k("p"), "p", pa.array(p))
                .set_column(k("taken"), "taken", pa.array((p >= 1.0).astype(np.int32)))
                .set_column(k("open"), "open", pa.array(open_)))

    return units.groupBy("sid", "grp").applyInArrow(group, UNIT)


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED,
           group: int = GROUP, fanout: int = FANOUT) -> DataFrame:
    """One row per distinct row of ``docs``: key (fingerprint of the row), doc_id, n (how often it
    occurs), size, source_size, target, base (copies of each), extra (of the n, so many take one
    more)."""
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    rows = U.stored(docs.select(F.xxhash64(*row_key(docs)).alias("key"), F.col(id_col).alias("doc_id"),
                                F.col(source_col).alias("source"), size.alias("size"))
                    .groupBy("key", "doc_id", "source", "size").agg(F.count("*").alias("n")), "mix-units")
    stats = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.count("*").alias("rows"))
    listed = stats.limit(MAX_SOURCES + 1).collect()
    if len(listed) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    listed.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goal = targets([r["words"] for r in listed], weights, share, cap)
    plan = [(k, r["source"], r["words"], goal[k], goal[k] / r["words"] if r["words"] else 0.0,
             max(1, math.ceil(r["rows"] / group))) for k, r in enumerate(listed)]
    table = spark.createDataFrame(plan, "sid int, source string, source_size long, target double, rate double, groups long")

    unit = rows.join(F.broadcast(table), rows["source"].eqNullSafe(table["source"])).drop("source")
    mass = F.col("rate") - F.floor("rate")
    ord_ = F.xxhash64(F.lit(seed), "key", "size")
    unit = unit.select(
        "key", "doc_id", "n", "size", "source_size", "target", "sid", F.floor("rate").cast("int").alias("base"),
        F.floor(F.col("n") * mass + 1e-9).alias("sure"), "groups", ord_.alias("ord"),
        F.when(F.col("size") > 0, F.greatest(F.lit(0.0), F.col("n") * mass - F.floor(F.col("n") * mass + 1e-9)))
        .otherwise(0.0).alias("p"))
    dealt = unit.filter("p > 1e-9").select(
        "sid", F.pmod(F.shiftrightunsigned("ord", 7), F.col("groups")).alias("grp"), "ord", "key", "size", "p",
        F.lit(0).alias("taken"), F.lit(True).alias("open"))
    most, level, decided = max([x[-1] for x in plan], default=1), 0, None
    while True:
        done = U.stored(_round(dealt, level, seed, most == 1), f"mix-level{level}")
        part = done.filter("taken = 1").select("key", "sid")
        decided = part if decided is None else decided.unionByName(part)
        if most == 1:
            break
        most, level = math.ceil(most / fanout), level + 1
        dealt = done.filter("open").withColumn("grp", F.floor(F.col("grp") / fanout).cast("long"))
    chosen = decided.select("key", F.col("sid").alias("_s"))
    return (unit.join(chosen, (unit["key"] == chosen["key"]) & (unit["sid"] == chosen["_s"]), "left")
            .select(unit["key"], "doc_id", "n", "size", "source_size", "target", "base",
                    (F.col("sure") + F.when(F.col("_s").isNotNull(), 1).otherwise(0)).cast("long").alias("extra")))


def row_key(docs: DataFrame) -> list:
    """All columns, in an order of their own, as arguments of a fingerprint."""
    return [F.col(f"`{c}`") for c in sorted(docs.columns)]


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    c = copies(docs, **options)
    return (c.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * (F.col("base") + (F.col("_k") <= F.col("extra")).cast("int"))).cast("long").alias("taken")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it was drawn, all columns kept."""
    key, n, times, k = U.free_names(docs, "__key", "__n", "__times", "__k")
    c = copies(docs, **options).select(
        F.col("key").alias(key), F.col("n").alias(n), (F.col("n") * F.col("base") + F.col("extra")).alias(times))
    c = U.stored(c.filter(F.col(times) > 0), "mix-copies")
    keyed = docs.withColumn(key, F.xxhash64(*row_key(docs))).join(U.small_side(c), key)
    once = keyed.filter(F.col(n) == 1)
    many = keyed.filter(F.col(n) > 1).dropDuplicates([key])
    return (once.unionByName(many).withColumn(k, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
            .drop(key, n, times, k))

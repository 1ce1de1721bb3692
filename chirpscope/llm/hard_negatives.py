"""Hard negatives by anchor-clustered shared lists (exact maximum inner product search).

Anchors are clustered by direction.  All members of a cluster share one list of candidates, sorted by
an upper bound of the inner product with any unit vector of the cluster: with the angle t between the
candidate v and the cluster's centre and the cluster's radius r, that is |v| cos(max(0, t - r)).  A
member walks the list downwards and stops, certified, where the bound times its own length falls
below the worst score that it still needs.

Each search walks twice.  The first walk takes the ``HEAD`` best-bounded candidates of every cluster;
what its members find there bounds from below what they need.  The second takes every candidate whose
bound reaches what some member of the cluster needs, and only those are shuffled.  A cluster of many
members is cut into blocks of ``MEMBERS``, a long list is dealt to several tasks (each sorted by
bound; the parts' results are merged), and candidates stream through a task in Arrow batches, so no
task holds a group whole.  Positives are searched in lists of the cluster's label, negatives in lists
of all labels.

Equal vectors of a label are searched for once, and of the rows that hold one only the first
``positives + 1`` (or ``negatives``) by id can be answers, so copies cost neither pairs nor skew.

The centres are fitted on at most ``SAMPLE`` anchors; they change the time, never a result.

Cases: rows with a null id, a null label, a null or empty vector, a null or non-finite component, or a
component of 2**26 and more after scaling take no part; vectors of different length are compared as
if zeros followed the shorter; rows with equal ids are rows of their own (ties by id, then by place in
the input); other columns are ignored; an empty table or no anchor gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirpscope.llm import common as U

SCALE = 256
LIMIT = 1 << 26
#: Anchors that one block of a cluster holds; anchors that the centres are fitted on; most centres.
MEMBERS = 1024
SAMPLE = 4096
CENTRES = 1024
#: Candidates of a list that the first walk takes, and candidates of the table for each part of a list.
HEAD = 1024
PART_ROWS = 200_000
#: What rounding may take from a bound, relative to the candidate's length.
SLACK = 1e-6
CHUNK = 2048

ROW = "g string, kind int, bound double, id long, vec_id long, label string, x binary, low array<double>, high array<double>, need double"


# --- rows ---------------------------------------------------------------------------------


def usable(vectors: DataFrame, anchor: Column, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """id (of the row), vec_id, label, x (int32 bytes), anchor: rows that take part (stored)."""
    U.small_batches(vectors.sparkSession, 1024)
    v = F.col(vec_col)
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < LIMIT / SCALE))
    rows = (vectors.withColumn("__anchor", F.coalesce(anchor, F.lit(False)))
            .filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine)
            .select(F.monotonically_increasing_id().alias("id"), F.col(id_col).cast("long").alias("vec_id"),
                    F.col(label_col).cast("string").alias("label"),
                    F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("int")).alias("x"), F.col("__anchor").alias("anchor")))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x")
            flat, off = x.flatten().to_numpy(zero_copy_only=False).astype("<i4"), x.offsets.to_numpy() - x.offsets[0].as_py()
            raw = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((off * 4).astype(np.int32)), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "vec_id": b.column("vec_id"), "label": b.column("label"),
                                              "x": raw, "anchor": b.column("anchor")})

    return U.stored(rows.mapInArrow(packed, "id long, vec_id long, label string, x binary, anchor boolean"), "mining-rows")


def matrix(raw: pa.Array, dim: int) -> np.ndarray:
    """Stored vectors as integers in double precision, zeros behind short ones."""
    out = np.zeros((len(raw), dim))
    for i, r in enumerate(raw.to_pylist()):
        v = np.frombuffer(r, "<i4")
        out[i, :len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


# --- clusters -------------------------------------------------------------------------------


def centres(sample: np.ndarray, k: int) -> np.ndarray:
    """Unit centres by spherical k-means; always at least one."""
    rng = np.random.default_rng(3)
    norm = np.linalg.norm(sample, axis=1)
    unit = sample[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        out = np.zeros((1, sample.shape[1]))
        out[0, 0] = 1.0
        return out
    own = unit[rng.choice(len(unit), min(k, len(unit)), replace=False)]
    for _ in range(8):
        near = (unit @ own.T).argmax(axis=1)
        total = np.zeros_like(own)
        np.add.at(total, near, unit)
        size = np.linalg.norm(total, axis=1)
        own = np.where(size[:, None] > 0, total / np.maximum(size, 1e-300)[:, None], own)
    return own


def _cosines(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.linalg.norm(x, axis=1)
    return norm, np.clip(x @ centre.T / np.where(norm > 0, norm, 1.0)[:, None], -1.0, 1.0)


def clustered(nodes: DataFrame, centre: np.ndarray) -> DataFrame:
    """``nodes`` with c (its centre), norm and angle to it (stored)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                norm, cos = _cosines(matrix(b.column("x"), centre.shape[1]), centre)
                c = cos.argmax(axis=1)
                angle = np.where(norm > 0, np.arccos(cos[np.arange(len(c)), c]), 0.0)
                yield pa.RecordBatch.from_pydict({k: b.column(k) for k in ("id", "label", "x")}
                                                 | {"c": c.astype(np.int32), "norm": norm, "angle": angle})

    return U.stored(nodes.select("id", "label", "x").mapInArrow(
        run, "id long, label string, x binary, c int, norm double, angle double"), "mining-nodes")


def lists(candidates: DataFrame, members: DataFrame, key: list[str], centre: np.ndarray) -> DataFrame:
    """Candidates by list: ``key``, blocks, radius, cut, bound, and the candidate's columns.  ``members``:
    ``key``, c, angle, cut.  Where every cut is null, all candidates are in each list of their key."""
    keys = U.stored(members.groupBy(*key).agg(
        (F.max("angle") + SLACK / 10).alias("radius"), F.min("cut").alias("cut"),
        F.ceil(F.count("*") / MEMBERS).cast("int").alias("blocks")), "mining-lists")
    wide = {r["c"]: (r["radius"], r["cut"]) for r in keys.groupBy("c").agg(F.max("radius").alias("radius"), F.min("cut").alias("cut")).collect()}
    at = np.array(sorted(wide), np.int64)
    radius = np.array([wide[c][0] for c in at.tolist()])
    cut = np.array([wide[c][1] for c in at.tolist()])
    own = centre[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                norm, cos = _cosines(matrix(part.column("x"), centre.shape[1]), own)
                angle = np.arccos(cos)
                bound = norm[:, None] * (np.cos(np.maximum(0.0, angle - radius)) + SLACK)
                row, col = np.nonzero(bound >= cut)
                for o in range(0, len(row), 4096):
                    i, j = row[o:o + 4096], col[o:o + 4096]
                    taken = part.take(pa.array(i))
                    yield pa.RecordBatch.from_pydict({k: taken.column(k) for k in ("id", "vec_id", "label", "x")} | {
                        "c": at[j].astype(np.int32), "norm": norm[i], "angle": angle[i, j]})

    spread = candidates.select("id", "vec_id", "label", "x").mapInArrow(
        run, "id long, vec_id long, label string, x binary, c int, norm double, angle double")
    bound = F.col("norm") * (F.cos(F.greatest(F.lit(0.0), F.col("angle") - F.col("radius"))) + SLACK)
    return (spread.join(U.small_side(keys), key).withColumn("bound", bound).filter("bound >= cut")
            .select(*dict.fromkeys(["label", *key]), "id", "vec_id", "x", "bound", "blocks"))


# --- the walk -------------------------------------------------------------------------------


def _padded(lists_: list[list[float]], fill: float) -> np.ndarray:
    out = np.full((len(lists_), max(map(len, lists_), default=0)), fill)
    for i, v in enumerate(lists_):
        out[i, :len(v)] = v
    return out


class _Walk:
    """The members of one group and what they have found.  ``low`` and ``high`` are the ranges that each
    member asks about (one column a range), ``need`` a score below which nothing is needed."""

    def __init__(self, rows: pa.RecordBatch, dim: int, k: int, same: bool):
        self.k, self.same = k, same
        self.ids = rows.column("id").to_numpy()
        self.x = matrix(rows.column("x"), dim)
        self.norm = np.linalg.norm(self.x, axis=1)
        self.label = np.array(rows.column("label").to_pylist(), object)
        self.low = _padded(rows.column("low").to_pylist(), np.inf)
        self.high = _padded(rows.column("high").to_pylist(), -np.inf)
        self.floor = np.maximum(self.low, rows.column("need").to_numpy()[:, None])
        self.found = np.zeros((5, 0), np.int64)               # member, range, score, vec_id, id

    def take(self, rows: pa.RecordBatch, dim: int) -> bool:
        """Score a sorted run of the list; False once no member needs anything below it."""
        top = rows.column("bound")[0].as_py()
        # a range that nothing can satisfy needs nothing
        live = np.flatnonzero(((top * self.norm[:, None] >= self.floor) & (self.low <= self.high)).any(axis=1))
        if not len(live):
            return False
        scores = products(self.x[live], matrix(rows.column("x"), dim))
        label = np.array(rows.column("label").to_pylist(), object)
        other = self.label[live][:, None] == label[None, :]
        if not self.same:
            other = ~other
        vec_id, ids = rows.column("vec_id").to_numpy(), rows.column("id").to_numpy()
        fresh = []
        for j in range(self.low.shape[1]):
            fits = other & (scores >= self.floor[live, j][:, None]) & (scores <= self.high[live, j][:, None])
            if fits.shape[1] > self.k:
                best = -np.partition(np.where(fits, -scores, np.iinfo(np.int64).max), self.k - 1, axis=1)[:, self.k - 1]
                fits &= scores >= best[:, None]
            m, c = np.nonzero(fits)
            fresh.append(np.stack([live[m], np.full(len(m), j), scores[m, c], vec_id[c], ids[c]]))
        self.found = self._best(np.concatenate([self.found, *fresh], axis=1))
        return True

    def _best(self, found: np.ndarray) -> np.ndarray:
        """The first k of every member and range, and their floors raised to the k-th score."""
        found = found[:, np.lexsort((found[4], found[3], -found[2], found[1], found[0]))]
        new = np.ones(found.shape[1], bool)
        new[1:] = (found[:2, 1:] != found[:2, :-1]).any(axis=0)
        nth = np.arange(len(new)) - np.maximum.accumulate(np.where(new, np.arange(len(new)), 0)) if len(new) else new
        last = found[:, nth == self.k - 1]
        self.floor[last[0], last[1]] = np.maximum(self.floor[last[0], last[1]], last[2])
        return found[:, nth < self.k]

    def result(self) -> pa.RecordBatch:
        m, j, score, vec_id, ids = self.found
        return pa.RecordBatch.from_pydict({"node": self.ids[m], "nth": j.astype(np.int32), "score": score, "vec_id": vec_id, "id": ids})


def walk(listed: DataFrame, members: DataFrame, key: list[str], parts: int, dim: int, k: int, same: bool) -> DataFrame:
    """node, nth (of its ranges), score, vec_id, id: the best k candidates of every member and range,
    of each part of its list.  ``members``: ``key``, id, label, x, blocks, low, high, need."""
    name = F.concat_ws("/", *[F.col(c).cast("string") for c in reversed(key)])     # the label, if any, comes last
    group = F.concat_ws("/", F.col("block").cast("string"), F.col("part").cast("string"), name)
    none = F.lit(None).cast("array<double>")
    rows = listed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
    rows = rows.select(group.alias("g"), F.lit(1).alias("kind"), "bound", "id", "vec_id", "label", "x",
                       none.alias("low"), none.alias("high"), F.lit(None).cast("double").alias("need"))
    who = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    who = who.select(group.alias("g"), F.lit(0).alias("kind"), F.lit(0.0).alias("bound"), "id",
                     F.lit(None).cast("long").alias("vec_id"), "label", "x", "low", "high", "need")
    spark = listed.sparkSession
    both = (who.unionByName(rows).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "g")
            .sortWithinPartitions("g", "kind", F.desc("bound"), "vec_id", "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, walker, going = None, [], None, False
        for b in batches:
            g, kind = b.column("g"), b.column("kind").to_numpy()
            names = np.array(g.to_pylist(), object)
            edge = np.flatnonzero((names[1:] != names[:-1]) | (kind[1:] != kind[:-1])) + 1
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), b.num_rows]):
                if e <= s:
                    continue
                if names[s] != now:
                    if walker is not None:
                        yield walker.result()
                    now, held, walker, going = names[s], [], None, True
                run_ = b.slice(s, e - s)
                if kind[s] == 0:
                    held.append(run_)
                elif held or walker is not None:
                    if walker is None:
                        walker = _Walk(pa.Table.from_batches(held).combine_chunks().to_batches()[0], dim, k, same)
                        held = []
                    for o in range(0, run_.num_rows, CHUNK):
                        going = going and walker.take(run_.slice(o, CHUNK), dim)
        if walker is not None:
            yield walker.result()

    U.small_batches(spark, CHUNK)
    return both.mapInArrow(run, "node long, nth int, score long, vec_id long, id long")


def search(nodes: DataFrame, candidates: DataFrame, key: list[str], centre: np.ndarray, parts: int, k: int, same: bool) -> DataFrame:
    """node, nth, score, vec_id, id, place: the first k candidates of every node and range.  ``nodes``:
    id, label, x, c, norm, angle, low, high (stored)."""
    dim = centre.shape[1]

    def merged(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("node", "nth").orderBy(F.desc("score"), "vec_id", "id")
        return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)

    def blocks(members: DataFrame) -> DataFrame:
        sizes = members.groupBy(*key).agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("blocks"))
        return members.join(sizes, key)

    everything = F.lit(float("-inf"))
    asked = nodes.withColumn("cut", everything).withColumn("need", everything)
    by_bound = Window.partitionBy(*key).orderBy(F.desc("bound"), "id")
    head = (lists(candidates, asked, key, centre).withColumn("place", F.row_number().over(by_bound))
            .filter(F.col("place") <= HEAD).drop("place"))
    seen = U.stored(merged(walk(head, blocks(asked), key, 1, dim, k, same)), "mining-head")
    # a range with k finds needs nothing below the last of them, any other nothing below its low end
    last = seen.filter(F.col("place") == k).groupBy("node").agg(
        F.map_from_entries(F.collect_list(F.struct("nth", F.col("score").cast("double")))).alias("last"))
    floors = F.transform(F.col("low"), lambda lo, i: F.when(lo <= F.get("high", i), F.greatest(
        lo, F.coalesce(F.element_at("last", i.cast("int")), lo))))
    asked = nodes.join(last, nodes["id"] == last["node"], "left").drop("node")
    asked = asked.withColumn("need", F.array_min(floors)).filter(F.col("need").isNotNull()).drop("last")
    cut = F.when(F.col("norm") > 0, F.col("need") / F.col("norm")).when(F.col("need") <= 0, everything).otherwise(F.lit(float("inf")))
    asked = U.stored(asked.withColumn("cut", cut), "mining-asked")
    if asked.isEmpty():
        return seen
    found = walk(lists(candidates, asked, key, centre), blocks(asked), key, parts, dim, k, same)
    return U.stored(merged(found), "mining-found")


# --- the operator -----------------------------------------------------------------------------


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row that
    ``anchor`` marks and each of its first positives, the first rows of another label whose score lies
    between ``least`` and ``most`` percent of the positive's."""
    spark = vectors.sparkSession
    rows = usable(vectors, anchor, id_col, vec_col, label_col)
    size = rows.agg(F.max(F.octet_length("x")), F.count("*"), F.count_if("anchor")).head()
    if not size[2]:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    dim, parts = size[0] // 4, -(-size[1] // PART_ROWS)
    copies = Window.partitionBy("label", "x").orderBy("vec_id", "id")
    candidates = U.stored(rows.withColumn("nth", F.row_number().over(copies)).filter(F.col("nth") <= max(positives + 1, negatives))
                          .select("id", "vec_id", "label", "x"), "mining-candidates")
    anchors = rows.filter("anchor").select("id", "vec_id", "label", "x")
    nodes = U.stored(anchors.groupBy("label", "x").agg(F.min("id").alias("id")), "mining-anchors")
    anchors = U.stored(anchors.join(nodes.withColumnRenamed("id", "node"), ["label", "x"]).select("node", "id", "vec_id"), "mining-members")
    count = nodes.count()
    sample = nodes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("x").toArrow().column("x").combine_chunks()
    centre = centres(matrix(sample, dim), min(CENTRES, -(-count // MEMBERS)))
    nodes = clustered(nodes, centre)

    wide = F.array(F.lit(float("-inf"))), F.array(F.lit(float("inf")))
    found = search(nodes.withColumn("low", wide[0]).withColumn("high", wide[1]), candidates, ["label", "c"], centre, parts, positives + 1, True)
    near = found.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("place", "score", "vec_id", "id"))).alias("near"))
    near = U.stored(near, "mining-positives")
    asked = near.select("node", F.array_distinct(F.transform("near", lambda p: p["score"])).alias("scores"))
    asked = U.stored(nodes.join(asked, nodes["id"] == asked["node"]).drop("node").select(
        "*", F.transform("scores", lambda s: F.ceil(s * least / 100).cast("double")).alias("low"),
        F.transform("scores", lambda s: F.floor(s * most / 100).cast("double")).alias("high")), "mining-ranges")
    hard = search(asked.drop("scores"), candidates, ["c"], centre, parts, negatives, False)
    hard = (hard.join(asked.select(F.col("id").alias("node"), "scores"), "node")
            .select("node", F.get("scores", F.col("nth")).alias("positive_score"), F.col("place").cast("int").alias("rank"),
                    F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))
    pairs = anchors.join(near, "node").select("node", F.col("vec_id").alias("anchor_id"), F.explode(F.slice(
        F.filter("near", lambda p: p["id"] != F.col("id")), 1, positives)).alias("p"))
    return (pairs.select("node", "anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"))
            .join(hard, ["node", "positive_score"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))

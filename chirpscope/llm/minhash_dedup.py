"""MinHash near-duplicates with an LSH forest.

A document's set is its distinct ``shingle``-word shingles, as 64-bit fingerprints.  Documents
with equal sets are one node (a text copied any number of times is one row from here on).  Each
node has ``TREES * DEPTH`` MinHash values; tree t sorts all nodes by its own ``DEPTH`` labels.  In
such an order the nodes with the longest common prefix stand side by side, so candidates are the
next ``REACH`` nodes that share at least ``MIN_PREFIX`` labels: where nodes are sparse this takes
whole regions of short prefixes, where they are dense only the deepest ones - the depth adapts to
each region and no region makes all its pairs.  Orders are cut by range over tasks (ties broken by
sketch and node, so any region can be cut) and the rows on both sides of a cut are compared once
more, so a cut loses nothing while a partition has at least REACH rows; their number follows the
counted rows to see to that.

A region of at most REACH nodes is compared whole.  With d labels down to such a region, a node
misses a partner of similarity 0.8 in that tree with probability 1 - 0.8**d; in all 24 trees with
2e-11 at d = MIN_PREFIX.  The walk notes each node's crowded depth in each tree, and nodes that the
crowd leaves a chance of more than ``MISS`` to miss a partner are compared beyond REACH, see below.

A 2-bit sketch of the MinHash values drops candidates whose estimate is over four standard
deviations too low, and so do set sizes that are too unequal.  Candidates are confirmed on the
full sets of both texts, in two walks: the first confirms a spanning forest of each neighbourhood
(a few pairs a node, however dense the group); the second looks, among groups of candidates that
are not one component by then, at the pairs that lie in different components.  There a vector of
shingle counts in ``COUNTS`` hash buckets bounds the intersection from above - exactly - and what
it cannot rule out is confirmed on the texts too.  Last come the crowded runs: where more nodes than
REACH spans share MIN_PREFIX labels in a tree and are not one component, all pairs of the run that
lie in different components are compared, block by block, under the same bounds.

Cases: null, empty and word-less texts have no shingles and link with nothing; a text of fewer
words than a shingle is one shingle; rows with equal ids are judged by their texts, a component's
id is its smallest doc_id; other columns are ignored (kept by ``near_dedup``); an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpscope.llm import common as U
from chirpscope.llm.components import components

SHINGLE = 5
PERCENT = 80
TREES = 24
DEPTH = 8
MIN_PREFIX = 2
REACH = 96
#: Estimates below PERCENT by this much are dropped: over four standard deviations of the sketch.
SLACK = 0.15
SEED = 1_000_003
#: Nodes are at risk if a partner of similarity PERCENT escapes their walks with a higher probability.
MISS = 1e-6
#: Trees whose crowded runs are compared in full: (1 - 0.8**MIN_PREFIX)**14 is 6e-7.
FULL_TREES = 14
#: Rows of a partition of the sorted orders, at least (but for what the range sampling misjudges).
PART_ROWS = 8192

HASHES = TREES * DEPTH
_A = np.random.default_rng(SEED).integers(1 << 31, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = np.random.default_rng(SEED + 1).integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
#: Equal 2-bit values are pairs of equal bits; this keeps one bit of each pair.
_PAIR = np.uint64(0x5555555555555555)
SKETCH_WORDS = HASHES // 32

#: Buckets of the count vector, four bits each.
COUNTS = 256
NO_BOUND = 1 << 40

ORDER = {"tree": "int", "labels": "binary", "sketch": "binary", "node": "long", "n": "long"}
#: What the second walk carries besides.
ROOTED = {"root": "long", "counts": "binary"}
PAIR_ROW = "a long, b long"
CROWD_ROW = "run long, depth int"


# --- sets --------------------------------------------------------------------------------


def shingles(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle fingerprints of all texts (sorted within each), and the number of each."""
    data = U.LOWER[data]
    s, e, words = U.word_spans(data, off, U.NOSPACE)
    n = len(words)
    if not len(s):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    w = U.Prints(data).of(s, e)
    doc = np.repeat(np.arange(n), words)
    begin = np.cumsum(words) - words
    left = words[doc] - (np.arange(len(w)) - begin[doc])          # words from here to the end
    h = np.zeros(len(w), np.uint64)
    for k in range(size):
        part = np.zeros(len(w), np.uint64)
        part[:len(w) - k] = w[k:]
        part[left <= k] = 0
        h = U.mix(h * np.uint64(0x9FB21C651E98DF25) + part + np.uint64(k + 1))
    keep = (left >= size) | ((words[doc] < size) & (left == words[doc]))
    h, doc = h[keep], doc[keep]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[first], np.bincount(doc[first], minlength=n)


def minhashes(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of HASHES values for each non-empty set."""
    some = counts[counts > 0]
    begin = np.cumsum(some) - some
    x = (h >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(some), HASHES), np.uint32)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(x * _A[k] + _B[k], begin)
    return U.mix(out.astype(np.uint64)).astype(np.uint32)


def _sketch(mh: np.ndarray) -> np.ndarray:
    two = (mh & np.uint32(3)).astype(np.uint8)
    bits = np.stack([two & 1, two >> 1], axis=2).reshape(len(mh), -1)
    return np.packbits(bits, axis=1, bitorder="little")


def count_vectors(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Shingles in each of COUNTS buckets, two to a byte.  A set that overflows a bucket gets 15
    everywhere: "15 or more", see ``_most_shared``."""
    out = np.zeros((len(sizes), COUNTS), np.int64)
    np.add.at(out, (np.repeat(np.arange(len(sizes)), sizes), (U.mix(h) >> np.uint64(56)).astype(np.int64) % COUNTS), 1)
    out[out.max(axis=1) > 15] = 15
    out = out.astype(np.uint8)
    return out[:, ::2] | (out[:, 1::2] << 4)


def _most_shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """An upper bound of the intersection of two sets from their count vectors; NO_BOUND if both
    are 15 everywhere (two sets that overflow a bucket may share any number)."""
    most = np.minimum(x & 15, y & 15).sum(axis=1, dtype=np.int64) + np.minimum(x >> 4, y >> 4).sum(axis=1, dtype=np.int64)
    most[most == 15 * COUNTS] = NO_BOUND
    return most


def document_sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """doc_id, text_key, n (set size), node (null without shingles), the node's MinHash values and
    its count vector."""
    U.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in U.bulk(batches, "text"):
            h, n = shingles(*U.text_bytes(b.column("text")), size)
            some = np.flatnonzero(n)
            node = np.zeros(len(n), np.uint64)
            values, counts = np.full((2, len(n)), None, object)
            if len(some):
                begin = (np.cumsum(n) - n)[some]
                one, two = np.add.reduceat(U.mix(h), begin), np.bitwise_xor.reduceat(U.mix(h * np.uint64(3)), begin)
                node[some] = U.mix(one ^ U.mix(two + n[some].astype(np.uint64)))
                values[some] = [x.tobytes() for x in minhashes(h, n)]
                counts[some] = [x.tobytes() for x in count_vectors(h, n[some])]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "text_key": b.column("text_key"), "n": pa.array(n.astype(np.int64)),
                "node": pa.array(node.view(np.int64), mask=n == 0), "mh": pa.array(values.tolist(), pa.binary()),
                "counts": pa.array(counts.tolist(), pa.binary())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return U.stored(rows.mapInArrow(run, "doc_id long, text_key long, n long, node long, mh binary, counts binary"), "sets")


# --- candidates -----------------------------------------------------------------------------


def _order_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        mh = np.frombuffer(b"".join(b.column("mh").to_pylist()), np.uint32).reshape(-1, HASHES)
        same = {c: b.column(c) for c in b.schema.names if c != "mh"}
        same["sketch"] = pa.array([x.tobytes() for x in _sketch(mh)], pa.binary())
        for t in range(TREES):
            own = np.ascontiguousarray((mh[:, t * DEPTH:(t + 1) * DEPTH] >> 16).astype(">u2")).view(np.uint8)
            rows = same | {"tree": pa.array(np.full(len(mh), t, np.int32)), "labels": pa.array([x.tobytes() for x in own], pa.binary())}
            yield pa.RecordBatch.from_pydict({c: rows[c] for c in (*ORDER, *ROOTED) if c in rows})


def _estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x ^ y
    same = 1 - np.bitwise_count((d | (d >> np.uint64(1))) & _PAIR).sum(axis=1) / HASHES
    return (same - 0.25) / 0.75


def _flat(b: pa.RecordBatch, column: str, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(b.column(column).to_pylist()), kind).reshape(-1, width)


def _neighbours(rows: pa.RecordBatch, percent: int, cut: int | None = None) -> pa.RecordBatch:
    """Candidate pairs among sorted rows: at most REACH apart, sharing MIN_PREFIX labels; with
    ``cut`` only pairs on different sides of that place.  Rows without roots give a spanning
    forest of the candidates, rows with roots all that lie in different components."""
    n, rooted = rows.num_rows, "root" in rows.schema.names
    node, size, sketch = rows.column("node").to_numpy(), rows.column("n").to_numpy(), _flat(rows, "sketch", np.uint64, SKETCH_WORDS)
    labels = _flat(rows, "labels", np.uint8, 2 * DEPTH)
    prefix = rows.column("tree").to_numpy().astype(np.uint64)
    for k in range(2 * MIN_PREFIX):
        prefix = (prefix << np.uint64(8)) | labels[:, k].astype(np.uint64)
    group = rows.column("root").to_numpy() if rooted else node
    counts = _flat(rows, "counts", np.uint8, COUNTS // 2) if rooted else None
    left, right, score = [], [], []
    for o in range(1, min(REACH, n - 1) + 1):
        i = np.flatnonzero(prefix[:-o] == prefix[o:])
        if not len(i):
            break
        if cut is not None:
            i = i[(i < cut) & (i + o >= cut)]
        i = i[(group[i] != group[i + o]) & (100 * np.minimum(size[i], size[i + o]) >= percent * np.maximum(size[i], size[i + o]))]
        for at in range(0, len(i), 1 << 16):
            x = i[at:at + (1 << 16)]
            est = _estimate(sketch[x], sketch[x + o])
            good = est >= percent / 100 - SLACK
            x, est = x[good], est[good]
            if rooted:
                shared = np.minimum(_most_shared(counts[x], counts[x + o]), np.minimum(size[x], size[x + o]))
                good = 100 * shared >= percent * (size[x] + size[x + o] - shared)
                x, est = x[good], est[good]
            left.append(x)
            right.append(x + o)
            score.append(est)
    none = [np.zeros(0, np.int64)]
    i, j = np.concatenate(left or none), np.concatenate(right or none)
    if not rooted and len(i):
        keep = _spanning(i, j, np.concatenate(score), n)
        i, j = i[keep], j[keep]
    a, b = node[i], node[j]
    return pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _crowds(rows: pa.RecordBatch, cut: int | None = None) -> pa.RecordBatch:
    """(node, run, depth) of the sorted rows whose region, MIN_PREFIX labels deep, spans more than
    REACH rows: the run is the tree and those labels as one number, the depth the most labels
    whose region is still that crowded; with ``cut`` only regions that reach over that place."""
    n = rows.num_rows
    labels, tree = _flat(rows, "labels", np.uint8, 2 * DEPTH).view(">u2"), rows.column("tree").to_numpy()
    deep = np.zeros(n, np.uint8)
    if n > REACH:
        same = (labels[:-REACH] == labels[REACH:]) & (tree[:-REACH] == tree[REACH:])[:, None]
        deep[:-REACH] = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    if cut is not None:
        deep[cut:] = 0
        deep[:max(0, cut - REACH)] = 0
    span = 1
    while span <= REACH:                                    # the deepest of all windows over a row
        step = min(span, REACH + 1 - span)
        deep[step:] = np.maximum(deep[step:], deep[:-step])
        span += step
    i = np.flatnonzero(deep >= MIN_PREFIX)
    run = tree[i].astype(np.int64)
    for k in range(MIN_PREFIX):
        run = (run << 16) | labels[i, k]
    return pa.RecordBatch.from_pydict({"node": rows.column("node").take(pa.array(i)), "run": run, "depth": deep[i].astype(np.int32)})


def _spanning(i: np.ndarray, j: np.ndarray, est: np.ndarray, n: int) -> np.ndarray:
    """Places of the pairs that make a spanning forest, best estimates first."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    keep = []
    for k in np.argsort(-est, kind="stable").tolist():
        x, y = find(int(i[k])), find(int(j[k]))
        if x != y:
            root[x] = y
            keep.append(k)
    return np.array(keep, np.int64)


def candidates(nodes: DataFrame, percent: int, count: int) -> tuple[DataFrame, DataFrame]:
    """Distinct candidate pairs (a < b) of nodes, and (node, run, depth) of the crowded ones.
    ``nodes``: node, n, mh, and for the second walk, which notes no crowds, root and counts;
    ``count``: its rows."""
    spark = nodes.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8192")
    kinds = ORDER | {c: k for c, k in ROOTED.items() if c in nodes.columns}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items())
    by = ["tree", "labels", "sketch", "node"]
    rows = nodes.select("mh", "node", "n", *[c for c in ROOTED if c in nodes.columns]).mapInArrow(_order_rows, schema)
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), count * TREES // PART_ROWS))
    rows = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    rooted = "root" in kinds

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of each batch with the REACH rows before it; the partition's own ends are passed
        on as rows of side 0 (its end) and 1 (its begin)."""
        part, head, tail = TaskContext.get().partitionId(), None, None
        for b in batches:
            if not b.num_rows:
                continue
            if head is None:
                head = b.slice(0, REACH)
            elif head.num_rows < REACH:
                head = _stacked([head, b.slice(0, REACH - head.num_rows)])
            both = b if tail is None else _stacked([tail, b])
            pairs = _neighbours(both, percent)
            if pairs.num_rows:
                yield _tagged(kinds, pairs)
            crowds = None if rooted else _crowds(both)
            if crowds is not None and crowds.num_rows:
                yield _tagged(kinds, crowds)
            tail = both.slice(max(0, both.num_rows - REACH))
        if head is not None:
            yield _tagged(kinds, tail, part=part, side=0)
            yield _tagged(kinds, head, part=part - 1, side=1)

    both = U.stored(rows.mapInArrow(walk, f"{PAIR_ROW}, {schema}, {CROWD_ROW}, part int, side int"), "forest")

    def across(t: pa.Table) -> pa.Table:
        t = t.sort_by([(c, "ascending") for c in ("side", *by)])
        cut = int(np.searchsorted(t["side"].to_numpy(), 1))
        t = t.combine_chunks().to_batches()[0]
        found = [_tagged({}, _neighbours(t, percent, cut), node="long")]
        if not rooted:
            found.append(_tagged({}, _crowds(t, cut), node="long"))
        return pa.Table.from_batches(found).select(["a", "b", "node", "run", "depth"])

    ends = both.filter("side is not null").select(*kinds, "part", "side").groupBy("part")
    cuts = U.stored(ends.applyInArrow(across, f"{PAIR_ROW}, node long, {CROWD_ROW}"), "cuts")
    every = both.select("a", "b", "node", "run", "depth").unionByName(cuts)
    return (U.stored(every.filter("a is not null").select("a", "b").distinct(), "candidates"),
            every.filter("depth is not null").select("node", "run", "depth"))


def _stacked(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _tagged(kinds: dict, given: pa.RecordBatch, node: str | None = None, **marks: int) -> pa.RecordBatch:
    """``given`` with the columns of the walk's output that it lacks: null, or as ``marks`` say."""
    n = given.num_rows
    own = kinds or {"node": node}
    every = {"a": "long", "b": "long"} | own | {"run": "long", "depth": "int"} | ({"part": "int", "side": "int"} if kinds else {})
    return pa.RecordBatch.from_pydict({
        c: given.column(c) if c in given.schema.names
        else pa.array(np.full(n, marks[c], np.int32)) if c in marks else pa.nulls(n, _ARROW[k]) for c, k in every.items()})


# --- crowded runs ----------------------------------------------------------------------------

#: Rows of a crowded run are compared in blocks of these sizes, so that a row is dealt to about
#: SPLITS blocks until the blocks are full.
LEAST_BLOCK, MOST_BLOCK, SPLITS = 2048, 8192, 16
SIDE = {"node": "long", "n": "long", "root": "long", "sketch": "binary", "counts": "binary"}


def at_risk(crowds: DataFrame, percent: int) -> DataFrame:
    """(run, node) of the nodes whose crowded regions leave a chance of more than MISS that a
    partner lies beyond REACH in every tree, for the runs of the first FULL_TREES trees."""
    p = min(percent, 99) / 100
    usual = math.log(1 - p ** MIN_PREFIX)
    deep = U.stored(crowds.groupBy("node", "run").agg(F.max("depth").alias("depth")), "crowds")
    here = F.when(F.col("depth") < DEPTH, F.log(1 - F.pow(F.lit(p), F.col("depth") + 1))).otherwise(0.0) - usual
    risky = deep.groupBy("node").agg(F.sum(here).alias("more")).filter(F.col("more") > math.log(MISS) - TREES * usual)
    first = deep.filter(F.shiftright("run", 16 * MIN_PREFIX) < FULL_TREES)
    return first.join(risky, "node").select("run", "node")


def _with_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            sketch = pa.array([x.tobytes() for x in _sketch(_flat(b, "mh", np.uint32, HASHES))], pa.binary())
            yield pa.RecordBatch.from_pydict({c: sketch if c == "sketch" else b.column(c) for c in SIDE})


def _far(t: pa.Table, percent: int) -> pa.Table:
    """Candidate pairs of two blocks (or in one) that lie in different components."""
    b = t.combine_chunks().to_batches()[0]
    first = b.column("second").to_numpy(zero_copy_only=False) == 0
    node, size, group = (b.column(c).to_numpy() for c in ("node", "n", "root"))
    sketch, counts = _flat(b, "sketch", np.uint64, SKETCH_WORDS), _flat(b, "counts", np.uint8, COUNTS // 2)
    one = bool(first.all())
    x, y = np.flatnonzero(first), np.flatnonzero(first if one else ~first)
    step, out = max(1, (1 << 17) // max(1, len(y))), []
    for at in range(0, len(x), step):
        u = x[at:at + step]
        i, j = np.repeat(u, len(y)), np.tile(y, len(u))
        good = (group[i] != group[j]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
        if one:
            good &= i < j
        i, j = i[good], j[good]
        good = _estimate(sketch[i], sketch[j]) >= percent / 100 - SLACK
        i, j = i[good], j[good]
        shared = np.minimum(_most_shared(counts[i], counts[j]), np.minimum(size[i], size[j]))
        good = 100 * shared >= percent * (size[i] + size[j] - shared)
        out.append(np.stack([node[i[good]], node[j[good]]]))
    a, b = np.concatenate(out or [np.zeros((2, 0), np.int64)], axis=1)
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def crowded(nodes: DataFrame, crowds: DataFrame, roots: DataFrame, percent: int) -> DataFrame | None:
    """Distinct candidate pairs (a < b), in different components, of all nodes at risk that share
    a crowded run; None if no such run is left open."""
    spark = nodes.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8192")
    rows = at_risk(crowds, percent).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = U.stored(rows, "run-rows")
    if rows.isEmpty():
        return None
    per = U.stored(rows.groupBy("run", "root").agg(F.count("*").alias("c")), "run-roots")
    whole = (per.groupBy("run").agg(F.sum("c").alias("rows"), F.min("root").alias("x"), F.max("root").alias("y"))
             .filter("x <> y").select("run", F.least(F.lit(MOST_BLOCK), F.greatest(F.lit(LEAST_BLOCK), F.ceil(F.col("rows") / SPLITS))).alias("size")))
    # a component of more rows than a block has blocks of its own, which need no look at each other
    own = per.join(whole, "run").withColumn("own", F.when(F.col("c") > F.col("size"), F.col("root")))
    unit = U.stored(own.groupBy("run", "own").agg(F.ceil(F.sum("c") / F.first("size")).alias("cuts")), "run-units")
    if unit.isEmpty():
        return None
    part = unit.select("run", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("k"))
    x, y = (part.select("run", F.col("own").alias(f"own_{s}"), F.xxhash64("own", "k").alias(s)) for s in "xy")
    pairs = x.join(y, "run").filter("x <= y and (own_x is null or own_y is null or own_x <> own_y)").select("run", "x", "y")
    tasks = U.stored(pairs.select("run", "x", "y", F.col("x").alias("block"), F.lit(0).alias("second")).unionByName(
        pairs.filter("x <> y").select("run", "x", "y", F.col("y").alias("block"), F.lit(1).alias("second"))), "run-tasks")
    unit = unit.withColumnRenamed("run", "run_")
    of_root = U.stored(own.join(unit.withColumnRenamed("own", "own_"), (F.col("run") == F.col("run_")) & F.col("own").eqNullSafe(F.col("own_")))
                       .select("run", "root", "own", "cuts"), "run-blocks")
    rows = (rows.join(U.small_side(of_root), ["run", "root"])
            .select("run", "node", "root", F.xxhash64("own", F.pmod(F.xxhash64("node"), F.col("cuts"))).alias("block")))
    rows = U.stored(rows, "run-members")
    wanted = rows.select("node", "root").distinct()
    small = wanted.join(nodes.select("node", "n", "mh", "counts"), "node").mapInArrow(_with_sketch, ", ".join(f"{c} {k}" for c, k in SIDE.items()))
    dealt = rows.select("run", "block", "node").join(U.stored(small, "run-nodes"), "node").join(U.small_side(tasks), ["run", "block"])
    found = dealt.groupBy("run", "x", "y").applyInArrow(lambda t: _far(t, percent), PAIR_ROW)
    return U.stored(found.distinct(), "far")


# --- confirmation ------------------------------------------------------------------------------


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough; ``texts``: node, text."""
    U.small_batches(pairs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in U.bulk(U.bulk([b], "ta", 1 << 20), "tb", 1 << 20):
                if not c.num_rows:
                    continue
                (ha, na), (hb, nb) = (shingles(*U.text_bytes(c.column(k)), size) for k in ("ta", "tb"))
                pair = np.concatenate([np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)])
                h = np.concatenate([ha, hb])
                order = np.lexsort((h, pair))
                h, pair = h[order], pair[order]
                same = (h[1:] == h[:-1]) & (pair[1:] == pair[:-1])
                inter = np.bincount(pair[1:][same], minlength=len(na))
                good = (100 * inter >= percent * (na + nb - inter)) & (inter > 0)
                yield pa.RecordBatch.from_arrays([c.column("a"), c.column("b")], ["a", "b"]).filter(pa.array(good))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInArrow(run, "a long, b long")


def node_components(docs: DataFrame, sets: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """(node, root) of all nodes that have a link."""
    nodes = U.stored(sets.filter("node is not null").groupBy("node").agg(
        F.first("n").alias("n"), F.first("mh").alias("mh"), F.first("counts").alias("counts"),
        F.min(F.struct("doc_id", "text_key")).alias("rep")), "nodes")
    found, crowds = candidates(nodes.select("node", "n", "mh"), percent, nodes.count())
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))

    def texts_of(pairs: DataFrame) -> DataFrame:
        wanted = U.stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "rep"), "node")
                          .select("node", F.col("rep.doc_id").alias("__id"), F.col("rep.text_key").alias("__key")), "wanted")
        wanted = U.small_side(wanted)
        return U.stored(source.join(wanted, source["doc_id"].eqNullSafe(wanted["__id"]) & (source["text_key"] == wanted["__key"]))
                        .select("node", "text"), "texts").dropDuplicates(["node"])

    texts = texts_of(found)
    sure = U.stored(confirm(found, texts, size, percent), "links")
    roots = components(sure)
    # groups of candidates that are not one component yet: look at their other pairs
    groups = components(found).withColumnRenamed("root", "grp").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = U.stored(groups, "groups")
    split = groups.groupBy("grp").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("grp")
    open_ = U.stored(groups.join(split, "grp").select("node", "root"), "open")
    rest, _ = candidates(nodes.join(open_, "node").select("node", "n", "mh", "root", "counts"), percent, open_.count())
    more = U.stored(confirm(rest, texts, size, percent), "links")
    if not more.isEmpty():
        sure = sure.unionByName(more)
        roots = components(sure)
    far = crowded(nodes, crowds, roots, percent)
    if far is None or far.isEmpty():
        return roots
    more = U.stored(confirm(far, texts_of(far), size, percent), "links")
    return roots if more.isEmpty() else components(sure.unionByName(more))


def component_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, n, root of every row of ``docs``; the root (null without shingles) is
    equal for rows of one component and for no others."""
    sets = document_sets(docs, id_col, text_col, size)
    roots = node_components(docs, sets, id_col, text_col, size, percent)
    return U.stored(sets.select("doc_id", "text_key", "n", "node").join(roots, "node", "left")
                    .select("doc_id", "text_key", "n", F.coalesce("root", "node").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    rows = component_table(docs, **options)
    least = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return rows.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component, the first by id, with all columns; texts without shingles stay."""
    rows = component_table(docs, id_col, text_col, **options).filter("root is not null")
    same = U.stored(rows.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n")), "same")
    first = same.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_key")).alias("k"))
    ranked = same.join(first, "root").withColumn("kept", F.struct("doc_id", "text_key").eqNullSafe(F.struct("k.doc_id", "k.text_key")))
    key = [F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")]
    gone = U.stored(ranked.filter("not kept").select(*key), "near-copies")
    again = U.stored(ranked.filter("kept and n > 1").select(*key), "repeated-rows")
    (text,) = U.free_names(docs, "__text")
    full = docs.withColumn(text, F.xxhash64(text_col))

    def match(side: DataFrame) -> Column:
        return full[id_col].cast("long").eqNullSafe(side["__id"]) & (full[text] == side["__key"])

    gone = U.small_side(gone)
    left = full.join(gone, match(gone), "left_anti")
    if again.isEmpty():
        return left.drop(text)
    once = left.join(again, match(again), "left_anti")
    many = left.join(again, match(again), "left_semi").dropDuplicates([id_col, text])
    return once.unionByName(many).drop(text)

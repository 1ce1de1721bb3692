"""Embedding near-duplicates with spherical-cap filters.

Filter directions come from a random product code: a direction is one code word for the first
half of the coordinates joined to one for the second half, so ``C`` words a half give ``C * C``
directions.  A vector is list-decoded to all directions whose cap it lies in (inner product over
``alpha``): with both halves' scores sorted, each word of one half takes a prefix of the other.
``alpha`` is the exact quantile of the sphere at which a vector meets ``FILTERS`` caps on average;
one that meets fewer than ``AT_LEAST`` takes its best ``AT_LEAST``.  Vectors that share a cap (and
a label) meet in one group, where cosines are computed in double precision.

A pair that shares several caps is counted in the first of them only, so a group returns
counts and a spanning forest of its links instead of pairs, and a cluster of any size costs no
quadratic output.  Groups over ``BLOCK`` rows are cut into blocks, each pair of blocks a group.

At cosine 0.93 two vectors of 64 dimensions shared a cap in at least 99.5 % of trials for any
number of nodes up to 10**8 (tests); closer ones practically always do.

Cases: a vector that is null, zero or holds nulls or non-finite numbers, or whose label is null,
links with nothing; equal vectors of a label are one node with a count; vectors of different
length never link; rows with equal ids are counted one by one; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpscope.llm import common as U
from chirpscope.llm.components import components

COSINE = 0.93
FILTERS = 48
AT_LEAST = 32
PER_FILTER = 12
WORDS = (16, 4096)
BLOCK = 1024
SEED = 71
#: Shorter vectors all share one filter.
LEAST_DIM = 8

KEY = "label long, dim int, filter long"


def words_for(nodes: int) -> int:
    """Code words a half: a power of two with about ``PER_FILTER`` nodes for each direction."""
    c = 1 << max(0, round(np.log2(max(1.0, nodes / PER_FILTER)) / 2))
    return int(min(max(c, WORDS[0]), WORDS[1]))


class Caps:
    """The filters of one dimension."""

    def __init__(self, dim: int, words: int, filters: float = FILTERS):
        rng = np.random.default_rng([SEED, dim, words])
        self.half = dim // 2
        self.codes = []
        for size in (self.half, dim - self.half):
            c = rng.standard_normal((words, size))
            self.codes.append(c / np.linalg.norm(c, axis=1, keepdims=True) * np.sqrt(size / dim))
        self.words = words
        x = np.linspace(-1, 1, 200_001)
        tail = np.cumsum(((1 - x * x) ** ((dim - 3) / 2))[::-1])[::-1]
        self.alpha = float(x[np.searchsorted(-tail, -tail[0] * min(1.0, filters / words ** 2))])

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Sorted filter numbers of every (unit) vector."""
        one, two = unit[:, :self.half] @ self.codes[0].T, unit[:, self.half:] @ self.codes[1].T
        order = np.argsort(-two, axis=1)
        out = []
        for s1, s2, o in zip(one, two, order):
            down = -s2[o]
            n = np.searchsorted(down, s1 - self.alpha, "right")
            if n.sum() < AT_LEAST:
                k = min(AT_LEAST, self.words)
                first = np.argsort(-s1)[:k]
                best = np.argsort(-(s1[first][:, None] - down[:k][None, :]).ravel())[:AT_LEAST]
                out.append(np.sort(first[best // k] * self.words + o[best % k]))
            else:
                out.append(np.sort(np.repeat(np.arange(self.words) * self.words, n) + o[U.spread(np.zeros(len(n), np.int64), n)]))
        return out


def valid_nodes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, node (null if the vector can't link), label, dim, vec (its bytes, in single
    precision if the column is, else in double)."""
    U.small_batches(vectors.sparkSession, 1024)
    single = vectors.schema[vec_col].dataType.simpleString() == "array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, dim, raw = [], [], []
            for v, l in zip(b.column("vec"), b.column("label").to_pylist()):
                x = None if not v.is_valid or l is None or v.values.null_count else v.values.to_numpy(zero_copy_only=False)
                if x is None or not len(x) or not np.isfinite(x).all() or not np.isfinite(n := np.linalg.norm(x)) or n == 0:
                    node.append(None)
                    dim.append(None)
                    raw.append(None)
                    continue
                data = np.concatenate([x, [float(l)]]).view(np.uint64)
                p = U.mix(data + np.arange(1, len(data) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                node.append(int(U.mix(np.array([np.bitwise_xor.reduce(U.mix(p)) ^ p.sum()], np.uint64)).view(np.int64)[0]))
                dim.append(len(x))
                raw.append((x + 0.0).astype(np.float32 if single else np.float64).tobytes())
            yield pa.RecordBatch.from_pydict({
                "vec_id": b.column("vec_id"), "node": pa.array(node, pa.int64()), "label": b.column("label"),
                "dim": pa.array(dim, pa.int32()), "vec": pa.array(raw, pa.binary())})

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"),
                          F.col(label_col).cast("long").alias("label"))
    return U.stored(rows.mapInArrow(run, "vec_id long, node long, label long, dim int, vec binary"), "vectors")


def _vectors(raw: list[bytes], dim: int) -> np.ndarray:
    """Stored vectors in double precision."""
    flat = b"".join(raw)
    return np.frombuffer(flat, np.float32 if len(flat) == 4 * dim * len(raw) else np.float64).astype(np.float64).reshape(len(raw), dim)


def cap_rows(nodes: DataFrame, words: int, filters: float, keys_only: bool) -> DataFrame:
    """One row for each node and filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caps: dict[int, Caps] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                of_dim = b.filter(pa.array(dims == d))
                for at in range(0, of_dim.num_rows, 64):         # some thousand rows a batch
                    yield rows(of_dim.slice(at, 64), d, caps)

    def rows(own: pa.RecordBatch, d: int, caps: dict[int, Caps]) -> pa.RecordBatch:
        x = _vectors(own.column("vec").to_pylist(), d)
        if d < LEAST_DIM:
            lists = [np.zeros(1, np.int64)] * len(x)
        else:
            if d not in caps:
                caps[d] = Caps(d, words, filters)
            lists = caps[d].decode(x / np.linalg.norm(x, axis=1, keepdims=True))
        at = pa.array(np.repeat(np.arange(len(x)), [len(k) for k in lists]))
        out = {"label": own.column("label").take(at), "dim": pa.array(np.full(len(at), d, np.int32)),
               "filter": pa.array(np.concatenate(lists))}
        if not keys_only:
            out |= {c: own.column(c).take(at) for c in ("node", "size", "vec")}
            out["caps"] = pa.array([k.astype(np.int32).tobytes() for k in lists], pa.binary()).take(at)
        return pa.RecordBatch.from_pydict(out)

    nodes.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return nodes.mapInArrow(run, KEY if keys_only else KEY + ", node long, size long, vec binary, caps binary")


def _group(filter_: int, x: np.ndarray, size: np.ndarray, caps: list[bytes], side: np.ndarray | None, cosine: float):
    """Counts of each row's links that belong to this group, and spanning links."""
    n = len(x)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    earlier = [np.frombuffer(c, np.int32) for c in caps]
    earlier = [c[c < filter_] for c in earlier]
    column = {f: k for k, f in enumerate(np.unique(np.concatenate(earlier)).tolist())}
    member = np.zeros((n, max(1, len(column))), np.float32)
    for i, c in enumerate(earlier):
        member[i, [column[f] for f in c.tolist()]] = 1
    counts, links = np.zeros(n, np.int64), []
    root = list(range(n))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for at in range(0, n, 512):
        near = unit[at:at + 512] @ unit.T >= cosine
        near[np.arange(len(near)), at + np.arange(len(near))] = False
        if side is not None:
            near &= side[at:at + 512][:, None] != side[None, :]
        own = near & (member[at:at + 512] @ member.T == 0)
        counts[at:at + 512] = own @ size
        # a row's links to rows of one tree of the forest so far add nothing: compare roots in bulk
        for i in np.flatnonzero(near.any(axis=1)):
            for j in np.flatnonzero(near[i, :at + i]).tolist():
                a, b = find(at + int(i)), find(j)
                if a != b:
                    root[a] = b
                    links.append((at + int(i), j))
                    if len(links) == n - 1:
                        break
    return counts, links


def near_links(nodes: DataFrame, cosine: float = COSINE, filters: float = FILTERS) -> DataFrame:
    """Rows (a, b, n): with b null, n more vectors are linked with node a; else a and b are linked.
    ``nodes``: node, label, dim, vec, size."""
    words = words_for(nodes.count())
    keys = ["label", "dim", "filter"]
    hot = U.stored(cap_rows(nodes, words, filters, True).groupBy(*keys).count().filter(F.col("count") > BLOCK)
                   .select(*keys, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "hot-caps")
    rows = cap_rows(nodes, words, filters, False).join(hot, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other")).drop("other", "blocks")
    by = [*keys, "x", "y"]
    rows = rows.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            starts = _starts(b, by)
            held = b.slice(starts[-1])
            yield from _groups(b.slice(0, starts[-1]), starts, cosine)
        if held is not None:
            yield from _groups(held, _starts(held, by), cosine)

    nodes.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    return rows.mapInArrow(run, "a long, b long, n long")


def _starts(b: pa.RecordBatch, by: list[str]) -> np.ndarray:
    first = np.zeros(b.num_rows, bool)
    first[0] = True
    for c in by:
        k = b.column(c).to_numpy()
        first[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(first)


def _groups(b: pa.RecordBatch, starts: np.ndarray, cosine: float) -> Iterator[pa.RecordBatch]:
    ends = np.append(starts[1:], b.num_rows)
    for s, e in zip(starts.tolist(), ends.tolist()):
        if e - s < 2 or s >= b.num_rows:
            continue
        g = b.slice(s, e - s)
        x = _vectors(g.column("vec").to_pylist(), g.column("dim")[0].as_py())
        side = g.column("own").to_numpy() if g.column("x")[0] != g.column("y")[0] else None
        counts, links = _group(g.column("filter")[0].as_py(), x, g.column("size").to_numpy(), g.column("caps").to_pylist(), side, cosine)
        node = g.column("node").to_numpy()
        some = np.flatnonzero(counts)
        a = np.concatenate([node[some], node[[i for i, _ in links]] if links else node[:0]])
        other = [None] * len(some) + [int(node[j]) for _, j in links]
        if len(a):
            yield pa.RecordBatch.from_pydict({"a": a, "b": pa.array(other, pa.int64()),
                                              "n": pa.array([*counts[some].tolist(), *[0] * len(links)], pa.int64())})


def embedding_links(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    cosine: float = COSINE, filters: float = FILTERS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows = valid_nodes(vectors, id_col, vec_col, label_col)
    nodes = U.stored(rows.filter("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("vec").alias("vec"), F.count("*").alias("size"),
        F.min("vec_id").alias("least")), "vector-nodes")
    found = U.stored(near_links(nodes.drop("least"), cosine, filters), "cap-links")
    counts = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    roots = components(found.filter("b is not null"))
    known = U.stored(nodes.select("node", "size", "least").join(counts, nodes["node"] == counts["a"], "left").drop("a")
                     .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "vector-roots")
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    known = known.join(least, "root").select("node", (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("links"), "component")
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return rows.select("vec_id", "node").join(known, "node", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.col("vec_id").eqNullSafe(own).alias("kept"))

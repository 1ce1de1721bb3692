"""Mention and tag co-occurrence graphs and their node metrics, as DataFrame jobs.

Graphs are edge DataFrames:

* directed   ``(source, target, weight)``   — mention graph ``user:<id> → @handle``
* undirected ``(node_u, node_v, weight)``   — tag graph, stored once with ``node_u < node_v``

Iterative algorithms (PageRank, betweenness, k-hop) are driver loops over
DataFrame rounds: each round is one join + one aggregation; the only values
brought to the driver are per-round scalars (error, dangling mass, frontier size).
Lineage is cut with reliable ``checkpoint()`` into the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from chirpscope import constants as C
from chirpscope.functions import text as TX
from chirpscope.operators import tiles
from chirpscope.operators.pairs import array_pairs, row_pairs
from chirpscope.session import checkpoint_dir, scratch_path


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


class PowerIterationFailedConvergence(RuntimeError):
    pass


# ---------------------------------------------------------------------------
# edge builders (GRF1, GRF2, AGG1, AGG2)
# ---------------------------------------------------------------------------

def mentions(posts: DataFrame) -> DataFrame:
    """One row per mention occurrence: ``(tweet_id, author_id, mention)`` (FN1, FN21)."""
    return posts.select("tweet_id", "author_id",
                        F.explode(TX.extract_mentions("tweet_text")).alias("mention"))


def hashtags(posts: DataFrame) -> DataFrame:
    """One row per tag occurrence, lower-cased: ``(tweet_id, hashtag)`` (FN2, FN21)."""
    return posts.select("tweet_id", F.explode(TX.extract_hashtags("tweet_text")).alias("hashtag"))


def marks(posts: DataFrame) -> DataFrame:
    """``(tweet_id, author_id, tweet_text)`` with nothing in the text but its mentions and tags, all
    of them in order: both edge builders find in it what they find in the whole text."""
    def found(pattern: str, sign: str):
        return F.transform(F.regexp_extract_all(TX.text_or_empty("tweet_text"), F.lit(pattern), 1), lambda m: F.concat(F.lit(sign), m))

    return posts.select("tweet_id", "author_id", F.concat_ws(" ", found(C.MENTION_PATTERN, C.HANDLE_PREFIX), found(C.HASHTAG_PATTERN, C.TAG_PREFIX)).alias("tweet_text"))


def mention_edges(posts: DataFrame) -> DataFrame:
    """Directed ``user:<author_id> → @handle``; a handle named twice in a post counts twice.
    Posts without an author share the node ``user:None``."""
    m = mentions(posts)
    return (m.groupBy(TX.user_key(F.coalesce(F.col("author_id").cast("string"), F.lit(C.UNKNOWN_AUTHOR))).alias("source"),
                      TX.handle_key("mention").alias("target"))
            .agg(F.count(F.lit(1)).alias("weight")))


def hashtag_edges(posts: DataFrame, inline_max: int = 64, hot_items: int = 4096) -> DataFrame:
    """Undirected tag pairs ``node_u < node_v``; weight = number of posts with both tags."""
    tags = posts.select("tweet_id", TX.extract_hashtags("tweet_text").alias("tags"))
    p = array_pairs(tags, "tweet_id", "tags", inline_max=inline_max, hot_items=hot_items)
    return (p.groupBy(TX.tag_key("u").alias("node_u"), TX.tag_key("v").alias("node_v"))
            .agg(F.count(F.lit(1)).alias("weight")))


def basket_edges(rows: DataFrame, group: str, item: str, hot_items: int = 4096) -> DataFrame:
    """Co-occurrence graph of items sharing a group (e.g. suppliers of one order)."""
    p = row_pairs(rows, group, item, hot_items=hot_items)
    return (p.groupBy(F.col("u").alias("node_u"), F.col("v").alias("node_v"))
            .agg(F.count(F.lit(1)).alias("weight")))


# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------

def _ends(edges: DataFrame, directed: bool):
    return ("source", "target") if directed else ("node_u", "node_v")


def arcs(edges: DataFrame, directed: bool) -> DataFrame:
    """``(src, dst, w)``: the directed form (undirected edges both ways)."""
    a, b = _ends(edges, directed)
    fwd = edges.select(F.col(a).alias("src"), F.col(b).alias("dst"), F.col("weight").cast("double").alias("w"))
    if directed:
        return fwd
    return fwd.unionByName(fwd.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))


def nodes_of(edges: DataFrame, directed: bool) -> DataFrame:
    a, b = _ends(edges, directed)
    return edges.select(F.col(a).alias("node")).unionByName(
        edges.select(F.col(b).alias("node"))).distinct()


def first_seen(edges: DataFrame, directed: bool) -> DataFrame:
    """Order of first appearance in the edge list sorted by its ends, first end before
    second: ``min(struct(u, v, side))`` — an aggregate, no global numbering."""
    a, b = _ends(edges, directed)
    s = edges.select(F.col(a).alias("node"), F.struct(F.col(a).alias("e1"), F.col(b).alias("e2"),
                                                       F.lit(0).alias("side")).alias("k"))
    t = edges.select(F.col(b).alias("node"), F.struct(F.col(a).alias("e1"), F.col(b).alias("e2"),
                                                       F.lit(1).alias("side")).alias("k"))
    return s.unionByName(t).groupBy("node").agg(F.min("k").alias("first_seen"))


#: Arcs of one partition of a round; a source with more is split over several.
ARCS_PER_PART = 200_000
#: Hubs whose list may be broadcast.
BROADCAST_HUBS = 500_000


# ---------------------------------------------------------------------------
# degree (GRF3)
# ---------------------------------------------------------------------------

def degree(edges: DataFrame, directed: bool) -> DataFrame:
    """Unweighted degree; directed = in + out; a self-loop counts twice."""
    a, b = _ends(edges, directed)
    ends = edges.select(F.col(a).alias("node")).unionAll(edges.select(F.col(b).alias("node")))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


# ---------------------------------------------------------------------------
# PageRank (GRF4)
# ---------------------------------------------------------------------------

def pagerank(edges: DataFrame, directed: bool, alpha: float = C.PAGERANK_ALPHA,
             max_iter: int = C.PAGERANK_MAX_ITER, tol: float = C.PAGERANK_TOL,
             raise_on_fail: bool = True) -> DataFrame:
    """Weighted PageRank: start 1/N, out-weights normalised, dangling mass spread
    evenly, stop when Σ|x − x_prev| < N·tol (an undirected edge counts both ways).

    One round = arcs ⋈ ranks on (source, slice) → ``groupBy(dst)`` (partial-aggregated).
    The arcs are partitioned once, by their counted number; a hub with more than
    ``ARCS_PER_PART`` arcs is cut into slices, and only hubs' ranks are replicated
    (their list is broadcast if it has at most ``BROADCAST_HUBS`` rows).
    Every node also has a *self arc* that carries its previous value and dangling
    flag through the same aggregation, so the rank state is referenced once per
    round (the plan grows linearly, not 2^k).  One scalar action per round.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    edges = edges.checkpoint(eager=True)       # computed once, re-read by every setup step
    a = arcs(edges, directed)
    out_w = a.groupBy("src").agg(F.sum("w").alias("ow")).where(F.col("ow") > 0)
    nodes = (nodes_of(edges, directed)
             .join(out_w.select(F.col("src").alias("node"), F.lit(False).alias("_has_out")), "node", "left")
             .select("node", F.col("_has_out").isNull().alias("dangling")))
    nodes = nodes.persist(StorageLevel.MEMORY_AND_DISK)
    n = nodes.count()
    if n == 0:
        nodes.unpersist()
        return spark.createDataFrame([], "node string, pagerank double")
    n_parts = max(1, -(-(a.count() + n) // ARCS_PER_PART))
    hubs = (a.groupBy("src").agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > ARCS_PER_PART)
            .select("src", F.ceil(F.col("_m") / ARCS_PER_PART).cast("int").alias("slices")).checkpoint(eager=True))
    n_hubs = hubs.count()
    split = n_hubs > 0
    if n_hubs <= BROADCAST_HUBS:
        hubs = F.broadcast(hubs)
    slices = F.coalesce(F.col("slices"), F.lit(1))

    def with_slices(df: DataFrame) -> DataFrame:
        return df.join(hubs, "src", "left") if split else df.withColumn("slices", F.lit(1))

    ext = (with_slices(a.join(out_w, "src"))
           .select("src", F.pmod(F.xxhash64("dst"), slices).cast("int").alias("slice"), "dst",
                   (F.col("w") / F.col("ow")).alias("wn"), F.lit(False).alias("self"))
           .unionByName(nodes.select(F.col("node").alias("src"), F.lit(0).alias("slice"), F.col("node").alias("dst"),
                                     F.lit(0.0).alias("wn"), F.lit(True).alias("self")))
           .repartition(n_parts, "src", "slice").persist(StorageLevel.MEMORY_AND_DISK))
    ranks = nodes.select("node", "dangling", F.lit(1.0 / n).alias("x"))
    dang = ranks.where("dangling").agg(F.coalesce(F.sum("x"), F.lit(0.0))).first()[0]
    for it in range(1, max_iter + 1):
        base = (alpha * dang + (1.0 - alpha)) / n
        spread = ranks.withColumnRenamed("node", "src").withColumn("slice", F.lit(0))
        if split:
            spread = (with_slices(spread).withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
                      .drop("slices"))
        j = ext.join(spread, ["src", "slice"])
        new = (j.groupBy(F.col("dst").alias("node"))
               .agg(F.sum(F.when(~F.col("self"), F.col("x") * F.col("wn"))).alias("s"),
                    F.max(F.when(F.col("self"), F.col("x"))).alias("x_prev"),
                    F.max(F.when(F.col("self"), F.col("dangling"))).alias("dangling"))
               .select("node", "dangling", "x_prev",
                       (F.lit(alpha) * F.coalesce(F.col("s"), F.lit(0.0)) + F.lit(base)).alias("x")))
        # one job per round: it computes the state, writes it to the checkpoint
        # folder (lineage cut) and, through ``observe``, returns the L1 change and
        # the dangling mass.  No persist/unpersist in the loop.
        obs = Observation(f"pagerank_{it}")
        new = new.observe(obs, F.sum(F.abs(F.col("x") - F.col("x_prev"))).alias("err"),
                          F.coalesce(F.sum(F.when(F.col("dangling"), F.col("x"))), F.lit(0.0)).alias("dang"))
        new = new.checkpoint(eager=True)
        row = obs.get
        ranks = new.select("node", "dangling", "x")
        dang = row["dang"]
        if row["err"] < n * tol:
            break
    else:
        if raise_on_fail and tol > 0:
            ext.unpersist()
            nodes.unpersist()
            raise PowerIterationFailedConvergence(f"pagerank: no convergence in {max_iter} rounds")
    final = ranks.select("node", F.col("x").alias("pagerank"))
    ext.unpersist()
    nodes.unpersist()
    return final


# ---------------------------------------------------------------------------
# betweenness (GRF5)
# ---------------------------------------------------------------------------

def betweenness(edges: DataFrame, directed: bool, weighted: bool = True,
                pivot_block: int | None = None, normalized: bool = True,
                pivot_state_rows: int = 20_000_000) -> DataFrame:
    """Exact betweenness (all pivots); edge weight is a *length*.

    For pivots s of a connected component (``operators.tiles``): (a) distances; (b) shortest-path
    DAG arcs with d(u) + w = d(v); (c) path counts σ over them; (d) dependencies
    δ(u) = Σ_v σ(u)/σ(v) (1 + δ(v)) on DAG arcs; (e) Σ_s δ_s(v), v ≠ s, scaled by 1/((n−1)(n−2)).
    A task holds the packed arcs of the component and does (a) to (d) for a part of its nodes, so only
    arcs are stored and dealt out, a copy for each part.  Parts are processed in blocks so that the arcs
    dealt out at once are bounded (``pivot_state_rows``, to be sized to the cluster, but two parts
    a core); every pivot is processed (exact).  Weights must be positive.

    In an undirected graph the trees that hang on it are folded first (``_fold_trees``): the
    rounds above run on what is left, whose nodes weigh as many nodes as they stand for.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    batch_rows = spark.conf.get(_BATCH, None)
    _collect_garbage(spark)                    # of what counted the edges' groups
    # computed once, re-read by every setup step; a table takes a tenth of a checkpoint's disk
    held = scratch_path(spark, "edges")
    edges.write.parquet(held)
    edges = spark.read.schema(edges.schema).parquet(held)
    _collect_garbage(spark)
    a = arcs(edges, directed).where(F.col("src") != F.col("dst"))
    if not weighted:
        a = a.withColumn("w", F.lit(1.0))
    try:
        least = a.agg(F.min("w")).head()[0]
        if least is not None and not least > 0:
            raise ValueError("betweenness needs positive edge weights")
        nodes = _cut(nodes_of(edges, directed))
        n = nodes.count()
        zero = nodes.select("node", F.lit(0.0).alias("betweenness"))
        if n <= 2:
            return zero
        if directed:
            # a node on a path needs an in- and an out-arc; none such → all zero
            mids = a.select(F.col("dst").alias("node")).distinct().join(
                a.select(F.col("src").alias("node")).distinct(), "node")
            if mids.limit(1).count() == 0:
                return zero
        if directed:
            core, weight, folds = a, nodes.select("node", F.lit(1.0).alias("omega")), []
        else:
            core, weight, folds = _fold_trees(a, nodes)
        path = scratch_path(spark, "betweenness")
        n_blocks = 0
        alone = weight
        if not core.isEmpty():
            if not directed:
                core = core.where(F.col("src") < F.col("dst"))
            placed = tiles.placed_nodes(core, weight)
            alone = weight.join(placed.select("node"), "node", "left_anti")
            packed = _cut(tiles.arc_tiles(core, placed, not directed))
            parts = _cut(tiles.source_parts(packed, placed))
            n_tasks, copies = parts.agg(F.count(F.lit(1)), F.sum("m")).head()
            n_blocks = (-(-placed.count() // pivot_block) if pivot_block
                        else max(1, min(-(-copies // pivot_state_rows), n_tasks // (2 * spark.sparkContext.defaultParallelism))))
            n_parts = max(1, 2 * n_tasks // n_blocks)
        # blocks of parts by a stable hash: no driver-side node list.  Each block ends as
        # (v, delta, size) rows appended to one shared table, so the plan does not grow with the blocks.
        spark.conf.set(_BATCH, tiles.BATCH_ROWS)   # a row is packed arcs of a tile
        for blk in range(n_blocks):
            (tiles.dependencies(packed, parts, blk, n_blocks, n_parts)
             .join(placed.select("node", "g", "num"), ["g", "num"])
             .select(F.col("node").alias("v"), "delta", "size").write.mode("append").parquet(path))
            _collect_garbage(spark)
        # a node without arcs reaches itself only
        (alone.select(F.col("node").alias("v"), F.lit(0.0).alias("delta"), F.col("omega").alias("size")).write.mode("append").parquet(path))
        total = spark.read.schema(f"v {a.schema['src'].dataType.simpleString()}, delta double, size double").parquet(path)
        scale = 1.0 / ((n - 1) * (n - 2)) if normalized else (1.0 if directed else 0.5)
        bc = total.groupBy(F.col("v").alias("node")).agg(F.sum("delta").alias("bc"), F.max("size").alias("size"))
        if folds:
            bc = _cut(bc)
            tree = _tree_pairs(folds, bc.select("node", "size"))
            bc = (bc.select("node", "bc").unionByName(tree).groupBy("node").agg(F.sum("bc").alias("bc")))
        return (nodes.join(bc.select("node", "bc"), "node", "left")
                .select("node", (F.coalesce(F.col("bc"), F.lit(0.0)) * F.lit(scale)).alias("betweenness")))
    finally:
        if batch_rows is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, batch_rows)


#: Rounds of folding; longer hanging paths keep their inner part as ordinary nodes.
FOLD_ROUNDS = 24


def _fold_trees(a: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Take off nodes of degree 1, round by round: (arcs left, (node, omega) left, folds).  A fold is
    (child, parent, omega) with the number of nodes that went with the child; the parent's omega
    grows by it.  Every path of a folded node to the rest leaves through its parent, so only the
    number of nodes behind it matters to the others."""
    omega = _cut(nodes.select("node", F.lit(1.0).alias("omega")))
    folds: list[DataFrame] = []
    core = a
    for _ in range(FOLD_ROUNDS):
        ends = core.groupBy("src").agg(F.max("dst").alias("m"), F.min("dst").alias("dst")).where("m = dst").drop("m")
        other = ends.select(F.col("src").alias("dst"), F.lit(True).alias("_end"))
        # of two ends that have only each other, the larger one is folded
        leaf = (ends.join(other, "dst", "left").where(F.col("_end").isNull() | (F.col("src") > F.col("dst")))
                .select(F.col("src").alias("child"), F.col("dst").alias("parent"))
                .join(omega.withColumnRenamed("node", "child"), "child"))
        leaf, n = _cut_count(leaf)
        if not n:
            break
        folds.append(leaf)
        gone = leaf.select(F.col("child").alias("node"))
        grown = leaf.groupBy(F.col("parent").alias("node")).agg(F.sum("omega").alias("_more"))
        omega = _cut(omega.join(gone, "node", "left_anti").join(grown, "node", "left")
                     .select("node", (F.col("omega") + F.coalesce("_more", F.lit(0.0))).alias("omega")))
        core = _cut(core.join(gone.withColumnRenamed("node", "src"), "src", "left_anti")
                    .join(gone.withColumnRenamed("node", "dst"), "dst", "left_anti").select("src", "dst", "w"))
    return core, omega, folds


def _tree_pairs(folds: list[DataFrame], sizes: DataFrame) -> DataFrame:
    """(node, bc): ordered pairs of nodes that a node separates because one of them was folded into it.
    With the sizes w of the node's folded branches, S and Q the sums of w and of its squares, and N
    nodes in its component, that is 2 (N - 1) S - Q - S²."""
    known = sizes                                  # (node, size of its component), core nodes first
    for leaf in reversed(folds):
        known = _cut(known.unionByName(leaf.join(known.withColumnRenamed("node", "parent"), "parent")
                                       .select(F.col("child").alias("node"), "size")))
    branches = folds[0]
    for leaf in folds[1:]:
        branches = branches.unionByName(leaf)
    per = branches.groupBy(F.col("parent").alias("node")).agg(
        F.sum("omega").alias("S"), F.sum(F.col("omega") * F.col("omega")).alias("Q"))
    return per.join(known, "node").select("node", (2 * (F.col("size") - 1) * F.col("S") - F.col("Q") - F.col("S") * F.col("S")).alias("bc"))


def _cut(df: DataFrame) -> DataFrame:
    """Round state: one job computes it and writes it to the shared checkpoint folder;
    the next round starts from that leaf (no lineage growth, survives lost executors)."""
    return df.checkpoint(eager=True)


def _collect_garbage(spark) -> None:
    """Spark removes the files of past shuffles only when the driver collects its garbage."""
    spark.sparkContext._jvm.System.gc()


_obs_seq = [0]


def _cut_count(df: DataFrame, cond=None) -> tuple[DataFrame, int]:
    """``_cut`` plus the number of rows (matching ``cond``), observed in the same job."""
    _obs_seq[0] += 1
    obs = Observation(f"rows_{_obs_seq[0]}")
    c = F.count(F.lit(1)) if cond is None else F.count_if(cond)
    out = df.observe(obs, c.alias("n")).checkpoint(eager=True)
    return out, int(obs.get["n"])


# ---------------------------------------------------------------------------
# metrics table, node types, top-k (GRF6, GRF7, GRF8, SRT7)
# ---------------------------------------------------------------------------

def centrality_table(edges: DataFrame, directed: bool, kind: str,
                     pagerank_kw: dict | None = None, betweenness_kw: dict | None = None) -> DataFrame:
    """``(node, degree, betweenness, pagerank, type, first_seen)`` for one graph.

    Empty graph → empty table with the schema.  (Every node has an edge here: nodes
    come from edges, so the "no edges" branch of the reference cannot arise.)
    """
    deg = degree(edges, directed)
    pr = pagerank(edges, directed, **(pagerank_kw or {}))
    bt = betweenness(edges, directed, **(betweenness_kw or {}))
    fs = first_seen(edges, directed)
    return (deg.join(bt, "node", "left").join(pr, "node", "left").join(fs, "node", "left")
            .select("node", F.col("degree").cast("long").alias("degree"),
                    F.coalesce("betweenness", F.lit(0.0)).alias("betweenness"),
                    F.coalesce("pagerank", F.lit(0.0)).alias("pagerank"),
                    F.lit(kind).alias("type"), "first_seen"))


def node_metrics(mention_metrics: DataFrame, hashtag_metrics: DataFrame) -> DataFrame:
    """Union of both graphs' tables plus the prefix-derived ``node_type`` (SET1, FN12)."""
    return (mention_metrics.unionByName(hashtag_metrics)
            .withColumn("node_type", TX.node_type("node")))


def top_nodes(metrics: DataFrame, types: Iterable[str], k: int = C.TOP_K,
              with_type: bool = True) -> DataFrame:
    """Top-k by PageRank, then degree, then first appearance (ties keep first-seen).

    PageRank is compared after rounding to 12 places: parallel sums differ in the
    last bits.  ``orderBy().limit()`` plans as TakeOrderedAndProject (per-task top-k).
    """
    types = list(types)
    m = metrics.where(F.col("node_type").isin(types))
    cols = ["node", "degree", "pagerank", "betweenness"] + (["node_type"] if with_type else [])
    # a saved metrics table (SRT8) has no first_seen: ties then go by node name
    tie = F.col("first_seen").asc() if "first_seen" in m.columns else F.col("node").asc()
    return (m.orderBy(F.round("pagerank", 12).desc(), F.col("degree").desc(), tie)
            .limit(k).select(*cols))


# ---------------------------------------------------------------------------
# display tables (GRF9), k-hop neighbourhood (GRF10), nodes by property (GRF11)
# ---------------------------------------------------------------------------

def viz_tables(m_edges: DataFrame, h_edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two-layer display tables; on a shared id the mention layer wins (SET4, JN5)."""
    mn = nodes_of(m_edges, True).select(F.col("node").alias("id"), F.col("node").alias("label"),
                                        F.lit(C.MENTION_NODE_COLOR).alias("color"))
    hn = (nodes_of(h_edges, False).join(nodes_of(m_edges, True), "node", "left_anti")
          .select(F.col("node").alias("id"), F.col("node").alias("label"),
                  F.lit(C.HASHTAG_NODE_COLOR).alias("color")))
    me = m_edges.select(F.col("source").alias("from"), F.col("target").alias("to"),
                        F.col("weight").alias("value"), F.lit(C.MENTION_EDGE_COLOR).alias("color"))
    he = h_edges.select(F.col("node_u").alias("from"), F.col("node_v").alias("to"),
                        F.col("weight").alias("value"), F.lit(C.HASHTAG_EDGE_COLOR).alias("color"))
    return mn.unionByName(hn), me.unionByName(he)


def neighbourhood(edges: DataFrame, directed: bool, start: str | Iterable[str], hops: int = 2) -> DataFrame:
    """Nodes within ``hops`` of the start node(s), with their smallest hop count.

    Edges are followed both ways (a display neighbourhood)."""
    spark = edges.sparkSession
    starts = [start] if isinstance(start, str) else list(start)
    a = arcs(edges, directed)
    if directed:
        a = a.unionByName(a.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    a = _cut(a.select("src", "dst").distinct())          # computed once, used by every hop
    seen = spark.createDataFrame([(s, 0) for s in starts], "node string, hop int")
    front = seen
    for h in range(1, hops + 1):
        nxt = (front.join(a.withColumnRenamed("src", "node"), "node")
               .select(F.col("dst").alias("node")).distinct()
               .join(seen.select("node"), "node", "left_anti")
               .withColumn("hop", F.lit(h)))
        nxt = _cut(nxt)
        seen = _cut(seen.unionByName(nxt))
        front = nxt
    return seen


def nodes_by_value(nodes: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Nodes of a display or metrics table whose ``column`` is in ``values`` (GRF11)."""
    key = "id" if "id" in nodes.columns else "node"
    return nodes.where(F.col(column).isin(list(values))).select(F.col(key).alias("node")).distinct()


def nodes_by_property(edges: DataFrame, directed: bool, column: str, values: Iterable) -> DataFrame:
    """Both ends of the edges whose ``column`` is in ``values``, distinct (GRF11)."""
    a, b = _ends(edges, directed)
    sel = edges.where(F.col(column).isin(list(values)))
    return sel.select(F.col(a).alias("node")).unionByName(sel.select(F.col(b).alias("node"))).distinct()

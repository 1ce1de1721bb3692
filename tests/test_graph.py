"""Graph operators against brute force and closed forms."""

import itertools
import pathlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chirpscope.operators import graph as G
from chirpscope.operators import pairs as P


def und(spark, edges):
    return spark.createDataFrame(edges, "node_u string, node_v string, weight long")


def brute_betweenness(nodes, adj):
    """Brandes with Dijkstra; adj[u] = {v: w}; directed sums, normalised 1/((n-1)(n-2))."""
    import heapq
    bc = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        dist, sigma, preds, order = {s: 0.0}, defaultdict(float), defaultdict(list), []
        sigma[s] = 1.0
        heap, seen = [(0.0, s)], set()
        while heap:
            d, u = heapq.heappop(heap)
            if u in seen:
                continue
            seen.add(u)
            order.append(u)
            for v, w in adj.get(u, {}).items():
                nd = d + w
                if v not in dist or nd < dist[v]:
                    dist[v] = nd
                    sigma[v] = sigma[u]
                    preds[v] = [u]
                    heapq.heappush(heap, (nd, v))
                elif nd == dist[v]:
                    sigma[v] += sigma[u]
                    preds[v].append(u)
        delta = defaultdict(float)
        for v in reversed(order):
            for u in preds[v]:
                delta[u] += sigma[u] / sigma[v] * (1 + delta[v])
            if v != s:
                bc[v] += delta[v]
    n = len(nodes)
    return {k: (v / ((n - 1) * (n - 2)) if n > 2 else 0.0) for k, v in bc.items()}


def test_star_path_cycle_betweenness(spark):
    star = [("c", x, 1) for x in "abcde" if x != "c"]
    bt = {r["node"]: r["betweenness"] for r in G.betweenness(und(spark, star), False).collect()}
    assert bt["c"] == pytest.approx(1.0)
    assert bt["a"] == pytest.approx(0.0)
    path = [("n1", "n2", 1), ("n2", "n3", 1), ("n3", "n4", 1), ("n4", "n5", 1)]
    bt = {r["node"]: r["betweenness"] for r in G.betweenness(und(spark, path), False).collect()}
    # path of 5: middle node lies on 4 of the 6 pairs not involving it
    assert bt["n3"] == pytest.approx(4 / 6)
    assert bt["n2"] == pytest.approx(3 / 6)


def test_weighted_betweenness_matches_brute_force(spark):
    rnd = random.Random(7)
    nodes = [f"#{i}" for i in range(9)]
    edges = {}
    for a, b in itertools.combinations(nodes, 2):
        if rnd.random() < 0.45:
            edges[(a, b)] = rnd.randint(1, 3)
    adj = defaultdict(dict)
    for (a, b), w in edges.items():
        adj[a][b] = w
        adj[b][a] = w
    used = sorted({x for e in edges for x in e})
    exp = brute_betweenness(used, adj)
    for block in (1, 7):
        got = {r["node"]: r["betweenness"]
               for r in G.betweenness(und(spark, [(a, b, w) for (a, b), w in edges.items()]), False,
                                      pivot_block=block).collect()}
        for k in used:
            assert got[k] == pytest.approx(exp[k], abs=1e-12)
    with pytest.raises(ValueError):
        G.betweenness(und(spark, [("#a", "#b", 1), ("#b", "#c", 0)]), False)


@pytest.mark.parametrize("rounds", [0, 1, 24])
def test_folded_trees_change_nothing(spark, monkeypatch, rounds):
    """Cycles with trees on them, trees alone, two nodes alone: exact however much is folded."""
    monkeypatch.setattr(G, "FOLD_ROUNDS", rounds)
    rnd = random.Random(11)
    edges = {(f"c{i}", f"c{(i + 1) % 5}"): rnd.randint(1, 2) for i in range(5)} | {("c0", "c2"): 3}
    names = [f"c{i}" for i in range(5)]
    for k in range(14):                          # a tree grows on the cycle
        edges[(rnd.choice(names), f"t{k}")] = rnd.randint(1, 3)
        names.append(f"t{k}")
    lone = ["r"]
    for k in range(6):                           # and one on its own
        edges[(rnd.choice(lone), f"s{k}")] = 1
        lone.append(f"s{k}")
    edges[("x", "y")] = 2
    adj = defaultdict(dict)
    for (a, b), w in edges.items():
        adj[a][b] = adj[b][a] = w
    used = sorted({x for e in edges for x in e})
    exp = brute_betweenness(used, adj)
    frame = und(spark, [(*sorted(e), w) for e, w in edges.items()] + [("c1", "c1", 1)])
    got = {r["node"]: r["betweenness"] for r in G.betweenness(frame, False, pivot_block=100).collect()}
    assert got.keys() == exp.keys()
    for k in used:
        assert got[k] == pytest.approx(exp[k], abs=1e-12), k


def test_folding_leaves_the_cycle(spark):
    frame = und(spark, [("a", "b", 1), ("b", "c", 1), ("a", "c", 1), ("c", "d", 1), ("d", "e", 1), ("d", "f", 1)])
    a = G.arcs(frame, False)
    core, omega, folds = G._fold_trees(a, G.nodes_of(frame, False))
    assert sorted((r["node"], r["omega"]) for r in omega.collect()) == [("a", 1.0), ("b", 1.0), ("c", 4.0)]
    assert core.count() == 6 and [f.count() for f in folds] == [2, 1]


def test_pagerank_splits_a_hub(spark, monkeypatch):
    monkeypatch.setattr(G, "ARCS_PER_PART", 30_000)
    n = 100_000
    star = spark.range(n).select(F.lit("hub").alias("node_u"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("node_v"), F.lit(1).cast("long").alias("weight"))
    got = G.pagerank(star, False, tol=1e-9)
    hub = got.where("node = 'hub'").head()["pagerank"]
    leaf = got.where("node <> 'hub'").agg(F.min("pagerank"), F.max("pagerank"), F.count(F.lit(1))).head()
    assert hub == pytest.approx((0.15 / (n + 1) + 0.85 * 0.15 * n / (n + 1)) / (1 - 0.85 ** 2), rel=1e-3)
    assert leaf[2] == n and leaf[0] == pytest.approx(leaf[1]) and hub + n * leaf[0] == pytest.approx(1.0, abs=1e-6)


def test_mention_graph_betweenness_zero(spark):
    e = spark.createDataFrame([("user:1", "@a", 2), ("user:2", "@a", 1), ("user:2", "@b", 1)],
                              "source string, target string, weight long")
    assert all(r["betweenness"] == 0.0 for r in G.betweenness(e, True).collect())


def test_pagerank_sums_to_one_and_one_hop_closed_form(spark):
    e = spark.createDataFrame([("user:1", "@a", 2), ("user:2", "@a", 1), ("user:2", "@b", 1)],
                              "source string, target string, weight long")
    pr = {r["node"]: r["pagerank"] for r in G.pagerank(e, True, tol=1e-12).collect()}
    assert sum(pr.values()) == pytest.approx(1.0)
    a = 0.85
    base = 1.0 / (4 + a * 2)
    assert pr["user:1"] == pytest.approx(base, rel=1e-6)
    assert pr["@a"] == pytest.approx(base * (1 + a * (1 + 0.5)), rel=1e-6)


def test_degree_and_first_seen(spark):
    e = und(spark, [("#a", "#b", 1), ("#a", "#c", 2), ("#b", "#c", 1)])
    deg = {r["node"]: r["degree"] for r in G.degree(e, False).collect()}
    assert deg == {"#a": 2, "#b": 2, "#c": 2}
    fs = {r["node"]: tuple(r["first_seen"]) for r in G.first_seen(e, False).collect()}
    assert sorted(fs, key=fs.get) == ["#a", "#b", "#c"]


def brute_pairs(groups):
    c = Counter()
    for items in groups.values():
        for a, b in itertools.combinations(sorted(set(items)), 2):
            c[(a, b)] += 1
    return c


@pytest.mark.parametrize("hot", [2, 3, 1000])
def test_row_pairs_hot_groups_exact(spark, hot):
    rnd = random.Random(hot)
    rows = [(g, rnd.randint(0, 12)) for g in range(6) for _ in range(rnd.randint(1, 15))]
    rows += [(99, i) for i in range(40)]          # one hot group
    df = spark.createDataFrame(rows, "g long, i long")
    got = Counter((r["u"], r["v"]) for r in P.row_pairs(df, "g", "i", hot_items=hot).collect())
    groups = defaultdict(list)
    for g, i in rows:
        groups[g].append(i)
    assert got == brute_pairs(groups)


def test_array_pairs_tiers_exact(spark):
    rnd = random.Random(3)
    data = [(k, [f"t{rnd.randint(0, 30)}" for _ in range(rnd.randint(0, 25))]) for k in range(30)]
    df = spark.createDataFrame(data, "id long, tags array<string>")
    exp = brute_pairs({k: v for k, v in data})
    for inline_max, hot in [(64, 4096), (3, 4096), (3, 6), (0, 2)]:
        got = Counter((r["u"], r["v"]) for r in P.array_pairs(df, "id", "tags", inline_max, hot).collect())
        assert got == exp, (inline_max, hot)


def test_hashtag_edges_dedupe_per_post(spark):
    posts = spark.createDataFrame(
        [(1, 10, "#Fed #fed #FED #rates"), (2, 11, "#rates #fed"), (3, 12, "#solo")],
        "tweet_id long, author_id long, tweet_text string")
    e = {(r["node_u"], r["node_v"]): r["weight"] for r in G.hashtag_edges(posts).collect()}
    assert e == {("#fed", "#rates"): 2}
    m = spark.createDataFrame([(1, 10, "@a @a @b")], "tweet_id long, author_id long, tweet_text string")
    me = {(r["source"], r["target"]): r["weight"] for r in G.mention_edges(m).collect()}
    assert me == {("user:10", "@a"): 2, ("user:10", "@b"): 1}
    m = spark.createDataFrame([(1, None, "@a"), (2, None, "@a")], "tweet_id long, author_id long, tweet_text string")
    assert [(r["source"], r["weight"]) for r in G.mention_edges(m).collect()] == [("user:None", 2)]


def test_neighbourhood_hops(spark):
    e = und(spark, [("#a", "#b", 1), ("#b", "#c", 1), ("#c", "#d", 1)])
    got = {r["node"]: r["hop"] for r in G.neighbourhood(e, False, "#a", 2).collect()}
    assert got == {"#a": 0, "#b": 1, "#c": 2}


def test_empty_graph_keeps_schema(spark):
    e = und(spark, [])
    assert G.pagerank(e, False).count() == 0
    assert G.degree(e, False).columns == ["node", "degree"]
    assert G.hashtag_edges(spark.createDataFrame([], "tweet_id long, tweet_text string")).count() == 0


def test_marks_keep_what_the_edges_are_made_of(spark):
    texts = ["RT @a: #Fed @a_b #fed's", "@" + "x" * 20 + "#y@z", None, "a@b.c ##d #Ä @", "#one#two @@p @q"]
    posts = spark.createDataFrame([(i % 4, None if i == 1 else i, t) for i, t in enumerate(texts)], "tweet_id long, author_id long, tweet_text string")
    for build in (G.mentions, G.hashtags, G.mention_edges, G.hashtag_edges):
        assert sorted(map(str, build(G.marks(posts)).collect())) == sorted(map(str, build(posts).collect()))


def test_row_pairs_parts_follow_the_work(spark, monkeypatch):
    monkeypatch.setattr(P, "PAIRS_PER_PART", 50)
    df = spark.createDataFrame([(g, i) for g in range(60) for i in range(g % 4 + 1)], "g long, i long")
    dealt = re.findall(r"hashpartitioning\(_g#\d+L?, (\d+)\), REPARTITION_BY_NUM", P.row_pairs(df, "g", "i")._jdf.queryExecution().executedPlan().toString())
    assert dealt and all(int(n) == sum(15 * (k + k * (k - 1) / 2) for k in range(1, 5)) // 50 + 1 for n in dealt)


def test_betweenness_of_a_dense_graph_in_tiles(spark, monkeypatch):
    """Components over several tiles, small ones that share one, a node pair alone: as by brute force,
    in a number of rounds that the pivots do not multiply."""
    monkeypatch.setattr(G.tiles, "TILE", 8)
    rnd = random.Random(5)
    edges = {(f"a{i:02}", f"a{j:02}"): rnd.randint(1, 3) for i, j in itertools.combinations(range(20), 2) if rnd.random() < 0.6}
    for k in range(4):
        edges |= {(f"b{k}{x}", f"b{k}{y}"): rnd.randint(1, 2) for x, y in itertools.combinations("pqrs", 2)}
    edges[("y", "z")] = 1
    adj = defaultdict(dict)
    for (a, b), w in edges.items():
        adj[a][b] = adj[b][a] = w
    exp = brute_betweenness(sorted(adj), adj)
    blocks = []
    inner = G.tiles.dependencies
    monkeypatch.setattr(G.tiles, "dependencies", lambda *a: blocks.append(a[2]) or inner(*a))
    got = {r["node"]: r["betweenness"] for r in G.betweenness(
        und(spark, [(a, b, w) for (a, b), w in edges.items()]), False, pivot_state_rows=2_000).collect()}
    assert blocks == [0] and got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], abs=1e-12), k


def folder_bytes(path):
    return sum(p.stat().st_size for p in pathlib.Path(re.sub("^file:", "", path)).rglob("*") if p.is_file())


def test_betweenness_stores_arcs_and_not_paths(spark, monkeypatch):
    """A dense graph has as many pairs as arcs and far more arcs on shortest paths: what is stored follows the arcs."""
    n = 220
    ids = spark.range(n)
    edges = (ids.select(F.col("id").alias("node_u")).crossJoin(ids.select(F.col("id").alias("node_v"))).where("node_u < node_v")
             .withColumn("weight", 1 + F.pmod(F.xxhash64("node_u", "node_v"), F.lit(3))))
    kept, inner = [], type(edges).checkpoint
    monkeypatch.setattr(type(edges), "checkpoint", lambda df, *a, **k: kept.append(inner(df, *a, **k)) or kept[-1])   # so none is removed
    before = folder_bytes(G.checkpoint_dir(spark))
    got = {r["node"]: r["betweenness"] for r in G.betweenness(edges, False).collect()}
    assert kept and folder_bytes(G.checkpoint_dir(spark)) - before < 20 * n * (n - 1) / 2 + 300_000
    adj = defaultdict(dict)
    for a, b, w in edges.collect():
        adj[a][b] = adj[b][a] = w
    exp = brute_betweenness(range(n), adj)
    assert got.keys() == exp.keys()
    assert all(got[k] == pytest.approx(exp[k], abs=1e-12) for k in exp)


@pytest.mark.parametrize("directed", [False, True])
def test_betweenness_in_parts_and_blocks(spark, monkeypatch, directed):
    """A component whose sources are several tasks' in several blocks, edges that come twice or the
    other way round, weights that are no whole numbers: as by brute force."""
    monkeypatch.setattr(G.tiles, "TILE", 6)
    monkeypatch.setattr(G.tiles, "WORK", 1)
    monkeypatch.setattr(G.tiles, "DENSE_WORK", 1)
    rnd = random.Random(3)
    names = [f"n{i:02}" for i in range(26)]
    rows = [(a, b, rnd.choice([0.5, 1.25, 1.75, 2.0, 300.0])) for a in names for b in names if a != b and rnd.random() < 0.15]
    rows += [(a, b, w + 0.5) for a, b, w in rows[:9]] + [("n03", "n03", 1.0), ("far", "off", 2.0), (None, "n01", 1.0)]
    adj = defaultdict(dict)
    for a, b, w in rows:
        for x, y in [(a, b)] if directed else [(a, b), (b, a)]:
            if None not in (x, y) and x != y:
                adj[x][y] = min(w, adj[x].get(y, w))
    exp = brute_betweenness([*names, "far", "off", "null"], adj)
    ends = "source string, target string" if directed else "node_u string, node_v string"
    blocks = []
    inner = G.tiles.dependencies
    monkeypatch.setattr(G.tiles, "dependencies", lambda *a: blocks.append(a[2]) or inner(*a))
    got = {r["node"] or "null": r["betweenness"] for r in G.betweenness(spark.createDataFrame(rows, ends + ", weight double"), directed, pivot_block=10).collect()}
    assert blocks == [0, 1, 2] and got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], abs=1e-12), k


@pytest.mark.parametrize("weights", [[1, 2, 3], [1], [0.1, 0.2, 0.30000000000000004, 0.7], list(range(1, 400)), [5_000_000_000, 1]])
def test_levels_and_lists_of_a_tile_agree(weights):
    T = G.tiles
    rnd = random.Random(7)
    n = 60
    adj = defaultdict(dict)
    for a, b in itertools.permutations(range(n), 2):
        if (a < 50) == (b < 50) and rnd.random() < 0.4:
            adj[a][b] = rnd.choice(weights)
    omega = np.array([rnd.choice([1.0, 4.0]) for _ in range(n)])
    src, dst, w = (np.array(x, t) for x, t in zip(zip(*((a, b, x) for a in adj for b, x in adj[a].items())), (np.int32, np.int32, float)))
    held = []
    for tile in (dst < 33, dst >= 33):
        packed = T._pack(dst[tile], src[tile], w[tile])
        assert sorted(zip(*map(list, T._unpack(*packed)))) == sorted(zip(dst[tile], src[tile], w[tile]))
        held.append(T._held(*T._in_order(*T._unpack(*packed)), n))
    lists = [T._by_lists(held, omega, lo, lo + 20) for lo in (0, 20, 40)]
    codes, values = np.zeros((n, n), np.uint8), sorted(set(w.tolist()))
    codes[dst, src] = [1 + values.index(x) for x in w] if len(values) < 256 else 0
    if len(values) < 256:
        for lo, (delta, size) in zip((0, 20, 40), lists):
            d, s = T._by_levels(codes, values, omega, lo, lo + 20, 10_000)
            assert d == pytest.approx(delta, rel=1e-12) and s.tolist() == size.tolist()
        assert T._by_levels(codes, values, omega, 0, 20, 0) is None or len(weights) == 1
    delta, size = T._shares(held, omega, 0, n)
    assert delta == pytest.approx(sum(x for x, _ in lists), rel=1e-12)
    near = np.eye(n)
    near[src, dst] = 1
    assert size.tolist() == ((np.linalg.matrix_power(near, n) > 0) @ omega).tolist()
    exp = brute_betweenness(range(n), adj)
    ones = T._shares(held, np.ones(n), 0, n)[0] / ((n - 1) * (n - 2))
    assert all(ones[k] == pytest.approx(exp[k], abs=1e-12) for k in range(n))


def test_forest_keeps_components():
    rnd = random.Random(2)
    links = [(rnd.randrange(k * 100, k * 100 + 60), rnd.randrange(k * 100, k * 100 + 60)) for _ in range(300) for k in range(4)]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*links)], names=["a", "b"])
    rows = [r for b in G.tiles._forest(iter([batch.slice(0, 700), batch.slice(700)])) for r in b.to_pylist()]
    nodes = {x for e in links for x in e}
    assert {r["a"] for r in rows} == nodes and len(rows) == len(nodes)

    def roots(pairs):
        up = {x: x for x in nodes}
        for _ in nodes:
            for a, b in pairs:
                up[a] = up[b] = min(up[a], up[b])
        return up
    assert roots([(r["a"], r["b"]) for r in rows]) == roots(links)

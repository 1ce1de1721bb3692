import random
import re
from collections import Counter

import numpy as np
import pytest

from chirpscope.llm import minhash_dedup as M

from .conftest import docs_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, size):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def brute(rows, size, percent=80):
    """(doc_id, set size, component id) of every row."""
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=repr)


@pytest.fixture(scope="module")
def rows(odd_rows):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 4)))
    out = [(r[0], r[1]) for r in odd_rows]
    for g in range(25):
        base = [word() for _ in range(rng.choice([3, 8, 30, 120]))]
        for k in range(rng.choice([1, 2, 5, 12])):
            w = list(base)
            for _ in range(int(len(w) * rng.choice([0, 0.02, 0.05, 0.1]))):
                w[rng.randrange(len(w))] = word()
            out.append((1000 + 100 * g + k, " ".join(w).upper() if k % 3 else " ".join(w)))
    base = [word() for _ in range(150)]
    for k in range(200):                                   # a dense family, wider than REACH
        w = list(base)
        for _ in range(k % 7):
            w[rng.randrange(len(w))] = word()
        out.append((9000 + k, " ".join(w)))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_components_match_brute_force(spark, rows, size):
    got = M.near_duplicates(docs_frame(spark, [(d, t, "en", "s") for d, t in rows]), size=size).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == brute(rows, size)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)


def test_shingles_and_estimates():
    from chirpscope.llm import common as U
    import pyarrow as pa
    h, n = M.shingles(*U.text_bytes(pa.array(["a b c", "a b", "b c a b", "", None, "a", "A\tB\nc"])), 2)
    assert n.tolist() == [2, 1, 3, 0, 0, 1, 2]
    sets = [set(h[e - k:e].tolist()) for e, k in zip(np.cumsum(n), n)]
    assert sets[0] == sets[6] and sets[1] < sets[0] and len(sets[0] & sets[2]) == 2 and not sets[5] & sets[0]
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:900], rng.integers(0, 1 << 63, 100, dtype=np.uint64)])
    mh = M.minhashes(np.concatenate([a, b]), np.array([1000, 1000]))
    v = M.count_vectors(np.concatenate([a, b]), np.array([1000, 1000]))
    assert M._most_shared(v[:1], v[1:])[0] >= 900
    s = M._sketch(mh).view(np.uint64)
    assert abs(M._estimate(s[:1], s[1:])[0] - 900 / 1100) < 0.12


def test_one_document_of_each_group_stays(spark, rows):
    df = docs_frame(spark, [(d, t, "en", "s") for d, t in rows])
    kept = M.near_dedup(df)
    want = sorted((d for d, n, c in set(brute(rows, 5)) if d == c or n == 0), key=repr)
    wordless = [d for d, t in rows if not shingle_set(t, 5)]
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([*(x for x in want if x not in wordless), *wordless], key=repr)


def test_empty(nothing):
    assert M.near_duplicates(nothing).collect() == [] and M.near_dedup(nothing).collect() == []


def test_count_vectors_of_long_texts_rule_out_no_true_link():
    h = np.sort(np.random.default_rng(5).choice(1 << 40, 12_100, replace=False).astype(np.uint64))
    v = M.count_vectors(np.concatenate([h[:12_000], h[100:]]), np.array([12_000, 12_000]))
    assert M._most_shared(v[:1], v[1:])[0] >= 11_900


def test_second_walk_keeps_pairs_of_long_texts():
    import pyarrow as pa
    h = np.sort(np.random.default_rng(5).choice(1 << 40, 12_100, replace=False).astype(np.uint64))
    h, n = np.concatenate([h[:12_000], h[100:]]), np.array([12_000, 12_000])
    rows = pa.RecordBatch.from_pydict({
        "mh": [x.tobytes() for x in M.minhashes(h, n)], "node": [1, 2], "n": n, "root": [1, 2],
        "counts": [x.tobytes() for x in M.count_vectors(h, n)]})
    pairs = [p for b in M._order_rows([rows]) for p in M._neighbours(b, 80).to_pylist()]
    assert {(p["a"], p["b"]) for p in pairs} == {(1, 2)}


def test_links_in_a_crowded_unlinked_family(spark):
    """Pages of one template, about 0.72 similar, and pairs over 0.8 among them: far more rows share
    all labels than REACH spans."""
    rng = random.Random(23)
    word = lambda: f"x{rng.randrange(1 << 30)}"
    base = [word() for _ in range(200)]

    def page(w, places):
        w = list(w)
        for at in places:
            w[at] = word()
        return w

    free = range(0, 200, 2)                                # no two changes share a shingle
    out = [page(base, rng.sample(free, 8)) for _ in range(3000)]
    for _ in range(60):                                    # 3 common and 5 own changes each: J = 179 / 219
        some = rng.sample(free, 13)
        w = page(base, some[:3])
        out += [page(w, some[3:8]), page(w, some[8:])]
    sets = [shingle_set(" ".join(w), 2) for w in out]
    seen = Counter(x for s in sets for x in s)
    column = {x: k for k, x in enumerate(x for x, n in seen.items() if n > 1)}
    held = np.zeros((len(out), len(column)), np.float32)
    for k, s in enumerate(sets):
        held[k, [column[x] for x in s if x in column]] = 1
    shared, size = (held @ held.T).astype(int), np.array([len(s) for s in sets])
    links = np.argwhere(np.triu(100 * shared >= 80 * (size[:, None] + size - shared), 1))
    least = list(range(len(out)))
    for _ in range(20):
        for a, b in links.tolist():
            least[a] = least[b] = min(least[a], least[b])
    got = M.near_duplicates(docs_frame(spark, [(k, " ".join(w), "en", "s") for k, w in enumerate(out)]), size=2).collect()
    got = {r["doc_id"]: r["component_id"] for r in got}
    assert {(3000 + 2 * k, 3001 + 2 * k) for k in range(60)} <= set(map(tuple, links.tolist()))
    missed = [(a, b) for a, b in links.tolist() if got[a] != got[b]]
    assert not missed, f"{len(missed)} of {len(links)} links missed"
    assert [got[k] for k in range(len(out))] == least


def test_crowded_depths_match_brute_force():
    import pyarrow as pa
    rng = np.random.default_rng(3)
    labels = rng.integers(0, [1, 2, 2, 4, 9, 9, 9, 9], (1500, M.DEPTH), endpoint=True).astype(">u2")
    tree = rng.integers(0, 2, 1500).astype(np.int32)
    order = np.lexsort((*labels.T[::-1], tree))
    labels, tree = labels[order], tree[order]
    rows = pa.RecordBatch.from_pydict({
        "tree": tree, "labels": pa.array([x.tobytes() for x in labels], pa.binary()), "node": np.arange(1500)})
    want = {}
    for i in range(1500):
        near = tree == tree[i]
        for d in range(1, M.DEPTH + 1):
            near = near & (labels[:, d - 1] == labels[i, d - 1])
            if near.sum() > M.REACH and d >= M.MIN_PREFIX:
                want[i] = d

    def depths(batches):
        return {n: d for b in batches for n, d in zip(b.column("node").to_pylist(), b.column("depth").to_pylist())}

    assert want and depths([M._crowds(rows)]) == want
    # cut into two partitions, with the regions that reach over the cut
    for cut in (96, 700, 1404):
        ends = rows.slice(cut - 96, 192)
        got = {}
        for b in (rows.slice(0, cut), rows.slice(cut), None):
            for n, d in depths([M._crowds(ends, 96) if b is None else M._crowds(b)]).items():
                got[n] = max(d, got.get(n, 0))
        assert got == want


def test_nodes_in_shallow_crowds_are_not_at_risk(spark):
    rows = [(1, t << 32, 2) for t in range(M.TREES)] + [(2, t << 32, M.DEPTH) for t in range(M.TREES)] + [(3, 0, M.DEPTH)]
    got = M.at_risk(spark.createDataFrame(rows, "node long, run long, depth int"), 80).collect()
    assert sorted(map(tuple, got)) == [(t << 32, 2) for t in range(M.FULL_TREES)]

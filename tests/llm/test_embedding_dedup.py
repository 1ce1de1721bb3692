import numpy as np
import pytest

from chirpscope.llm import embedding_dedup as E


def brute(rows, cosine):
    usable = {}
    for i, (_, v, l) in enumerate(rows):
        if v is not None and l is not None and v and None not in v:
            x = np.array(v, float)
            if np.isfinite(x).all() and np.linalg.norm(x) > 0:
                usable[i] = x / np.linalg.norm(x)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in usable:
        for j in usable:
            if j < i and rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        k = find(i)
        least[k] = min((x for x in (least.get(k), r[0]) if x is not None), default=None)
    return sorted(((r[0], links[i], least[find(i)]) for i, r in enumerate(rows)), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "n") for r in rows], "vec_id long, embedding array<float>, label int, size int, node string")


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out, n = [], 0
    for g in range(30):
        base = rng.standard_normal(64)
        for _ in range(int(rng.choice([1, 2, 6, 40]))):
            v = base + rng.choice([0.0, 0.15, 0.3, 0.4]) * rng.standard_normal(64)
            out.append((n, [float(np.float32(x)) for x in v], int(g % 4)))
            n += 1
    f = float("nan")
    out += [(900, None, 1), (901, [0.0] * 64, 1), (902, [None, 1.0], 1), (903, [f, 1.0], 1), (904, [float("inf"), 1.0], 1), (905, [], 1),
            (906, [1.0, 0.0], 1), (907, [2.0, 0.0], 1), (908, [1.0, 0.0], 2), (909, [1.0, 0.0], None), (910, [1.0], 1), (911, [1.0, 0.0], 1),
            (911, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (912, [-1.0, 0.0], 1)]
    return out


def result(df, **options):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in E.embedding_links(df, **options).collect()), key=repr)


def test_matches_brute_force(spark, rows):
    assert result(frame(spark, rows)) == brute(rows, 0.93)


def test_blocks_of_hot_filters_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 7)
    assert result(frame(spark, rows)) == brute(rows, 0.93)


def test_recall_at_the_threshold():
    """Pairs at cosine 0.93 exactly: the share that meets in some cap."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((3000, 64))
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y = 0.93 * x + np.sqrt(1 - 0.93 ** 2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    for nodes in (10_000, 1_000_000):
        caps = E.Caps(64, E.words_for(nodes))
        met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(caps.decode(x), caps.decode(y))]
        assert np.mean(met) > 0.995


def test_decoding_lists_every_cap():
    caps = E.Caps(16, 16)
    x = np.random.default_rng(0).standard_normal((50, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    words = np.concatenate([np.concatenate([np.repeat(caps.codes[0][i:i + 1], 16, 0), caps.codes[1]], axis=1) for i in range(16)])
    for row, got in zip(x, caps.decode(x)):
        every = np.flatnonzero(words @ row >= caps.alpha)
        assert got.tolist() == every.tolist() if len(every) >= E.AT_LEAST else set(every) <= set(got) and len(got) >= E.AT_LEAST


def test_empty(spark):
    assert result(frame(spark, [])) == []

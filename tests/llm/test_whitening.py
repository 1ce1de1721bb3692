import math

import numpy as np
import pytest

from chirpscope.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, index int, n int, component string, x string, deviation string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "c", "x", "d") for i, v in rows], SCHEMA)


def brute(rows, components=4):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for k, (i, x) in enumerate(kept):
        for c in range(min(components, len(e))):
            out.setdefault((i, c + 1), []).append((
                n, sum((n * a - s) ** 2 for a, s in zip(x, sums)),
                abs(float((np.array(x) - fit.mean(axis=0)) @ u[:, c]) / math.sqrt(e[c])), e[c] / e.sum()))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    base = rng.standard_normal((6, 6))
    v = [[float(np.float32(c)) for c in r] for r in rng.standard_normal((1500, 6)) @ base / 8]
    out = [(i, r) for i, r in enumerate(v)] + [(9000 + i, v[7]) for i in range(400)]
    nan = float("nan")
    return out + [(1, v[3]), (None, v[4]), (9991, None), (9992, [nan] * 6), (9993, [None] + v[0][1:]), (9994, [float("inf")] + v[0][1:])]


def test_matches_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 64)
    monkeypatch.setattr(W, "MID_BLOCKS", 3)
    want, got = brute(rows), {}
    for r in W.whiten(frame(spark, rows)).collect():
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert got.keys() == want.keys()
    for key, found in got.items():
        assert sorted((r["n"], r["deviation"]) for r in found) == sorted(x[:2] for x in want[key])
        for r, x in zip(sorted(found, key=lambda r: r["deviation"]), sorted(want[key], key=lambda x: x[1])):
            assert abs(abs(r["whitened"]) - x[2]) < 1e-8 and abs(r["explained"] - x[3]) < 1e-9 and r["identity_error"] < 1e-9
    signs = {}
    for (i, c), found in got.items():          # one sign for all rows: equal vectors have equal values
        for r in found:
            signs.setdefault((r["deviation"], c), set()).add(round(r["whitened"], 9))
    assert all(len(s) == 1 for s in signs.values())


def test_few_and_flat_dimensions(spark):
    got = W.whiten(frame(spark, [(1, [0.5, 1.0]), (2, [1.5, 1.0]), (3, [2.5, 1.0]), (4, [1.0])])).collect()
    assert sorted((r["vec_id"], r["component"]) for r in got) == [(i, c) for i in (1, 2, 3) for c in (1, 2)]
    assert all((r["whitened"] is None) == (r["component"] == 2) and r["n"] == 3 for r in got)
    assert [r["explained"] for r in got if r["component"] == 1] == [1.0] * 3


def test_one_row_and_large_entries(spark):
    assert [(r["whitened"], r["deviation"]) for r in W.whiten(frame(spark, [(1, [0.5, 1.0])])).collect()] == [(None, 0)] * 2
    got = W.whiten(frame(spark, [(1, [1e12, 1.0]), (2, [0.0, 0.5]), (3, [1e30, 0.0])])).collect()
    assert {r["vec_id"] for r in got} == {1, 2} and all(r["deviation"] is None for r in got)


def test_empty(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        df = W.whiten(frame(spark, rows))
        assert df.collect() == [] and df.columns == [c.split()[0] for c in W.SCHEMA.split(", ")]

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chirpscope.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, id long, node string, c string, x string, anchor string, bound string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "n", "c", "x", "a", "b") for r in rows], SCHEMA)


def brute(rows, every=50):
    good = [(i, [math.floor(256 * c) for c in v], l) for i, v, l in rows
            if i is not None and l is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v, _ in good), default=0)
    x = np.array([v + [0] * (width - len(v)) for _, v, _ in good], np.int64).reshape(len(good), width)
    out = []
    for a, (i, _, l) in enumerate(good):
        if i % every:
            continue
        score = x @ x[a]
        order = sorted((k for k in range(len(good)) if k != a), key=lambda k: (-score[k], good[k][0], k))
        for p in [k for k in order if good[k][2] == l][:5]:
            fits = [k for k in order if good[k][2] != l and 50 * score[p] <= 100 * score[k] <= 95 * score[p]][:3]
            out += [(i, good[p][0], r + 1, good[k][0], int(score[p]), int(score[k])) for r, k in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, every=50):
    got = H.mine(frame(spark, rows), F.col("vec_id") % every == 0)
    return sorted(tuple(r) for r in got.collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    base = rng.standard_normal((7, 16))
    out = []
    for i in range(1500):
        v = base[rng.integers(7)] * rng.uniform(0.2, 2) + 0.5 * rng.standard_normal(16)
        out.append((i, [float(np.float32(c / 4)) for c in v], int(rng.integers(4))))
    return out


def test_matches_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(H, "MEMBERS", 9)
    monkeypatch.setattr(H, "HEAD", 60)
    monkeypatch.setattr(H, "PART_ROWS", 500)
    monkeypatch.setattr(H, "CHUNK", 64)
    want = brute(rows, 20)
    assert len(want) > 100 and mined(spark, rows, 20) == want


def test_copies_ties_and_odd_rows(spark, rows):
    nan = float("nan")
    copies = [(2000 + i, rows[5][1], rows[5][2]) for i in range(300)] + [(3000 + i, rows[5][1], (rows[5][2] + 1) % 4) for i in range(300)]
    zeros = [(4000 + 25 * i, [0.0] * 16, i % 2) for i in range(8)]
    few = [(5000, [1.0] * 16, 77), (5050, [-1.0] * 16, 77), (5100, [2.0], 1), (5150, [0.5] * 20, 2)]
    odd = [(None, rows[0][1], 1), (6000, None, 1), (6050, [], 1), (6100, [nan] * 16, 1), (6150, rows[1][1], None), (6200, [None] * 16, 2)]
    same = [(100, rows[9][1], 1), (100, rows[9][1], 1)]
    every = rows[:500] + copies + zeros + few + odd + same
    assert mined(spark, every) == brute(every)


def test_empty_and_no_anchor(spark):
    assert mined(spark, []) == [] and mined(spark, [(3, [1.0, 2.0], 1), (4, [1.0, 1.0], 2)]) == []
    assert mined(spark, [(50, [1.0, 2.0], 1), (4, [1.0, 1.0], 2)]) == []


def test_the_walk_stops_early(spark, rows, monkeypatch):
    """Far fewer candidates reach the second walk than there are."""
    shares, inner = [], H.lists

    def counted(candidates, members, key, centre):
        out = inner(candidates, members, key, centre)
        if key == ["label", "c"]:
            shares.append(out.count())
        return out

    monkeypatch.setattr(H, "lists", counted)
    monkeypatch.setattr(H, "MEMBERS", 4)
    mined(spark, [(i, v, 0) for i, v, _ in rows], 50)
    assert shares[1] < 0.7 * shares[0]

from collections import Counter, defaultdict

import numpy as np
import pytest

from chirpscope.llm import mixing as M

from .conftest import docs_frame


def test_targets_are_capped_and_reshared():
    t = M.targets([10, 100, 1000, 10])
    assert t[0] == 20 and t[3] == 20 and abs(sum(t) - 1.5 * 1120) < 1e-6 and all(x <= 2 * s + 1e-9 for x, s in zip(t, [10, 100, 1000, 10]))
    assert M.targets([]) == [] and M.targets([0, 0]) == [0, 0]


@pytest.mark.parametrize("seed", range(5))
def test_pivot_moves_words_and_keeps_their_sum(seed):
    rng = np.random.default_rng(seed)
    p, size = rng.random(500), rng.integers(1, 400, 500)
    out, held = M.pivot(p, size, rng.random(501), last=False)
    assert abs((out * size).sum() - (p * size).sum()) < 1e-6
    assert sum((out > 0) & (out < 1)) <= 1 and (held < 0 or 0 < out[held] < 1)


def test_pivot_keeps_expectations():
    p, size, total = np.array([0.3, 0.6, 0.55, 0.2]), np.array([5, 9, 2, 7]), np.zeros(4)
    for s in range(4000):
        total += M.pivot(p, size, np.random.default_rng(s).random(5), last=True)[0]
    assert np.abs(total / 4000 - p).max() < 0.03


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    out = [(i, " ".join(["w"] * int(rng.integers(1, 60))), "en", "abcde"[min(4, int(rng.exponential(1.2)))]) for i in range(3000)]
    return out + [(7, "same row", "en", "b")] * 500 + [(-1, None, None, None), (-2, "no source here", None, None), (-3, "", "en", "a")]


def test_mix_meets_targets_and_repeats(spark, rows):
    df = docs_frame(spark, rows)
    one = sorted(map(tuple, M.mix_report(df, group=256, fanout=4).collect()), key=repr)
    assert len(one) == len(rows) and Counter(r[0] for r in one) == Counter(r[0] for r in rows)
    assert one == sorted(map(tuple, M.mix_report(df.repartition(7), group=256, fanout=4).collect()), key=repr)
    source = {r[0]: r[3] for r in rows if r[0] != 7}
    taken, target = defaultdict(int), {}
    for doc_id, size, whole, goal, took in one:
        assert took in (0, size, 2 * size)
        s = source.get(doc_id, rows[7][3])
        if doc_id != 7:
            taken[s] += took
            target[s] = goal
    taken["b"] += sum(r[4] for r in one if r[0] == 7 and r[1] == 2)
    for s, goal in target.items():
        assert abs(taken[s] - goal) <= 60 + (1500 if s == rows[7][3] else 0), s


def test_mixed_repeats_documents(spark, rows):
    df = docs_frame(spark, rows)
    out = M.mixed(df, group=256)
    assert out.columns == df.columns
    report = Counter()
    for r in M.mix_report(df, group=256).collect():
        report[r["doc_id"]] += r["taken"]
    got = Counter()
    for r in out.collect():
        got[r["doc_id"]] += len((r["text"] or "").split())
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in report.items() if v}


def test_odd_and_empty(odd, nothing):
    assert M.mix_report(nothing).collect() == [] and M.mixed(nothing).collect() == []
    assert len(M.mix_report(odd).collect()) == odd.count()

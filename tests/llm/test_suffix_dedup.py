import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chirpscope.llm import suffix_dedup as S

from .conftest import docs_frame


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def test_covers_are_perfect():
    for v, d in S.COVERS.items():
        assert sorted((a - b) % v for a in d for b in d if a != b) == list(range(1, v))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2 ** 62), st.booleans()), min_size=1, max_size=300, unique_by=lambda x: x[0]))
def test_keys_round_trip(pairs):
    pairs.sort()
    keys, again = np.array([k for k, _ in pairs], np.uint64), np.array([a for _, a in pairs])
    k, a = S.unpack_keys(S.pack_keys(keys, again))
    assert (k == keys).all() and (a == again).all()


@pytest.fixture(scope="module")
def rows(odd_rows):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("ab é") for _ in range(n))
    passage, out = text(90), [(r[0], (r[1] or "")[:3000] if r[1] else r[1]) for r in odd_rows]
    for i in range(60):
        p = passage[rng.randrange(40):][:rng.randrange(10, 80)]
        out.append((100 + i, text(rng.randrange(0, 80)) + p * rng.choice([1, 1, 2]) + text(rng.randrange(0, 40))))
    return out + [(200, "z" * 100), (201, "z" * 19), (202, "q" * 20), (203, out[-1][1]), (204, out[-1][1])]


@pytest.mark.parametrize("length", [20, 50])
def test_matches_brute_force(spark, rows, length, monkeypatch):
    monkeypatch.setattr(S.U, "GROUP_BYTES", 700)
    df = docs_frame(spark, [(d, t, "en", "s") for d, t in rows])
    got = S.remove_repeats(df, length=length, bucket=500)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, length)


def test_empty(nothing):
    assert S.remove_repeats(nothing).collect() == []

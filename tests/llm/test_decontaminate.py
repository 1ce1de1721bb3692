import hashlib
import random
import re

import numpy as np
import pytest

from chirpscope.llm import decontaminate as D

from .conftest import docs_frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    wins = []
    for name, text in items:
        w = words(text)
        wins += [("null" if name is None else str(name), w[i:i + 10]) for i in range(max(1, len(w) - 9)) if w]
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for name, x in wins:
            for i in range(len(w) - len(x) + 1):
                if w[i:i + len(x)] == x:
                    hit.update(range(i, i + len(x)))
                    found.add(name)
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def fixture(spark, odd_rows):
    rng = random.Random(5)
    vocabulary = ["the", "of", "and", "a", "to", "été", "x1", "fox", "ran", "far", "home", "Straße"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([14, 10, 11, 30, 10, 4, 1])] + [(3, text(12)), (None, text(13)), (50, None), (51, " ... "), (52, "The quick brown fox jumps over the lazy dog AND runs")]
    docs = [(r[0], r[1]) for r in odd_rows]
    for i in range(40):
        parts = [text(rng.randrange(0, 30))]
        for _ in range(i % 4):
            w = words(rng.choice(items)[1])
            a = rng.randrange(0, max(1, len(w) - 4))
            parts += [" ".join(w[a:a + rng.choice([6, 10, 20])]).upper(), text(3)]
        docs.append((100 + i, ", ".join(parts)))
    return docs, items, docs_frame(spark, [(d, t, "en", "s") for d, t in docs]), spark.createDataFrame(items, "item_id long, text string")


def result(found):
    return sorted((tuple(r)[:6] for r in D.digest(found).collect()), key=repr)


def test_matches_brute_force(fixture):
    docs, items, df, bench = fixture
    assert result(D.hits(df, bench)) == brute(docs, items)


def test_blocks_of_items_change_nothing(fixture):
    docs, items, df, bench = fixture
    assert result(D.hits(df, bench, block_bytes=300)) == brute(docs, items)


def test_proximity():
    lists = [np.array([3, 40]), np.array([4, 43]), np.array([5, 42, 44])]
    exact, near = D.match(lists, 2)
    assert exact.tolist() == [3] and sorted(near.tolist()) == [3, 40]


def test_clean_keeps_the_rest(fixture):
    docs, items, df, bench = fixture
    want = sorted((b[0] for b in brute(docs, items) if not b[5]), key=repr)
    kept = D.clean(df, bench)
    assert kept.columns == df.columns and sorted((r["doc_id"] for r in kept.collect()), key=repr) == want


def test_empty_tables(spark, odd, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.hits(nothing, none).collect() == []
    assert {r["contaminated"] for r in D.digest(D.hits(odd, none)).collect()} == {False}

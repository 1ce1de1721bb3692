import itertools
import random
import zlib

import numpy as np
import pytest

from chirpscope.llm import language_crf as L

from .conftest import docs_frame

SYLLABLES = {"xx": ["tion", "ing", "th", "er", "ou"], "yy": ["sch", "keit", "ung", "ü", "pf"], "zz": ["ción", "mente", "ñ", "que", "os"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for i in range(300):
        lang = rng.choice(["xx", "yy", "zz"])
        out.append((i, sentence(rng, lang, rng.randrange(3, 90)).title() + ".", lang, "s"))
    return out


def test_marginals_match_enumeration(monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 3)
    rng = np.random.default_rng(0)
    m = L.Crf(["a", "b"], np.zeros(0, np.uint64))
    m.trans, m.start = rng.standard_normal((2, 2)), rng.standard_normal(2)
    lens = np.array([1, 7, 0, 3, 4])
    emit = 2 * rng.standard_normal((lens.sum(), 2))
    got, at = m.marginals(emit, lens), 0
    for n in lens:
        want = np.zeros((n, 2))
        for path in itertools.product([0, 1], repeat=int(n)) if n else []:
            z = m.start[path[0]] + sum(emit[at + i, y] for i, y in enumerate(path)) + sum(m.trans[a, b] for a, b in zip(path, path[1:]))
            want[np.arange(n), path] += np.exp(z)
        if n:
            assert np.allclose(got[at:at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_held_out_languages(spark, rows):
    got = {r["doc_id"]: r for r in L.language_ids(docs_frame(spark, rows)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert held and all(got[r[0]]["held_out"] for r in held)
    assert np.mean([got[r[0]]["lang_pred"] == r[2] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_code_switched_text(spark, rows):
    rng = random.Random(7)
    model = L.fit(docs_frame(spark, rows))
    text = sentence(rng, "xx", 20) + " " + sentence(rng, "yy", 25) + " " + sentence(rng, "zz", 15)
    runs = L.label_runs(docs_frame(spark, [(1, text, None, "s"), (2, None, None, "s")]), model).orderBy("doc_id").collect()
    found = [(r["lang"], r["end"] - r["begin"]) for r in runs[0]["runs"]]
    assert [x for x, n in found if n > 25] == ["xx", "yy", "zz"] and runs[1]["runs"] == []


def test_odd_and_empty(spark, rows, odd, nothing):
    model = L.fit(docs_frame(spark, rows))
    got = {r["doc_id"]: r for r in L.predict(odd, model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (2, 3, 4, 5))
    assert L.predict(nothing, model).collect() == [] and L.language_ids(nothing).collect() == []
    assert {r["lang_pred"] for r in L.predict(odd, None).collect()} == {"und"}

import random

import numpy as np
import pytest

from chirpscope.llm import common as U
from chirpscope.llm import quality as Q

from .conftest import docs_frame


def test_additive_model_learns_shapes_and_pairs():
    rng = np.random.default_rng(0)
    x = rng.random((6000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) | (np.abs(x[:, 2] - 0.5) < 0.05)
    m = Q.Additive(x[:4000], y[:4000].astype(float))
    assert ((m.score(x[4000:]) > 0.5) == y[4000:]).mean() > 0.95 and (0, 1) in m.pairs


def test_scores_are_table_additions():
    rng = np.random.default_rng(1)
    x = rng.random((500, 3)).astype(np.float32)
    m = Q.Additive(x, (x[:, 0] > 0.6).astype(float))
    fine, rough = m._bins(x, m.edges), m._bins(x, m.coarse)
    z = m.start + sum(t[b] for t, b in zip(m.tables, fine)) + sum(t[rough[a], rough[b]] for t, (a, b) in zip(m.pair_tables, m.pairs))
    assert np.allclose(m.score(x), 1 / (1 + np.exp(-z)))


def test_features_do_not_depend_on_the_batch(odd_rows):
    import pyarrow as pa
    texts = pa.array([r[1] for r in odd_rows], pa.string())
    whole = Q.features(*U.text_bytes(texts))
    each = np.concatenate([Q.features(*U.text_bytes(texts[i:i + 1])) for i in range(len(texts))])
    assert np.allclose(whole, each) and np.isfinite(whole).all()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["the", "of", "and", "farm", "river", "stone", "walks", "slowly", "green", "hill"])
    rows, labels = [], []
    for i in range(600):
        w = [word() for _ in range(rng.randrange(20, 200))]
        bad = i % 4 == 0
        text = rng.choice([" ".join(x.upper() + "!!" for x in w), " ".join(w[:1] * len(w)), " | ".join(w)]) if bad else " ".join(w) + "."
        rows.append((i, text, "en", "s"))
        labels.append((i, 0 if bad else 1, 0))
    return docs_frame(spark, rows), spark.createDataFrame([*labels, (5, None, None), (None, 1, 0), (10_000, 1, 0)], "doc_id long, quality int, toxic int"), labels


def test_held_out_documents(labelled):
    docs, labels, truth = labelled
    got = {r["doc_id"]: r for r in Q.quality_scores(docs, labels).collect()}
    import zlib
    held = [(i, q) for i, q, _ in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] for i, _ in held) and sum(r["held_out"] for r in got.values()) == len(held)
    assert np.mean([got[i]["predicted"] == q for i, q in held]) > 0.97
    kept = Q.good_documents(docs, labels)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in got.items() if r["predicted"])


def test_odd_and_empty(spark, odd, nothing, labelled):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in Q.quality_scores(odd, none).collect()} == {0.5}
    assert Q.quality_scores(nothing, labelled[1]).collect() == []
    assert Q.quality_scores(odd, labelled[1]).count() == odd.count()


def test_no_document_is_rejected_without_labels(spark, labelled):
    import zlib
    docs = labelled[0]
    held = next(i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2)
    for rows in ([], [(1, None)], [(held, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert sorted(r["doc_id"] for r in Q.good_documents(docs, labels).collect()) == list(range(600))


def test_features_hold_few_texts_at_a_time(monkeypatch):
    import pyarrow as pa
    U.release()
    texts = pa.array([f"Line {i} of words, words and more.\n" * 100 + "END | here!" for i in range(500)] + [None, "", "one"])
    steps = []
    inner = Q.features
    whole = inner(*U.text_bytes(texts))
    U.release()
    monkeypatch.setattr(Q, "features", lambda data, off: steps.append(len(data)) or inner(data, off))
    assert np.array_equal(Q._features(texts), whole)
    assert max(steps) <= 256 << 10 and sum(len(p) for p in U._powers) <= 4 * (256 << 10)

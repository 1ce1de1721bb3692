import re
from collections import Counter

import corpus_pipeline as P
from chirpscope.llm import common as U

from .test_decontaminate import brute as contaminated
from .test_minhash_dedup import brute as near


def test_stages_on_the_smallest_tables(spark, sf):
    docs = U.read(spark, sf, "documents")
    columns, frames = docs.columns, [docs]
    for name, stage in P.STAGES:
        frames.append(U.stored(stage(spark, frames[-1], sf), name))
    rows = [{r["doc_id"]: r for r in f.collect()} for f in frames[:5]]
    assert all(f.columns == columns for f in frames[:5])
    good, single, clean = rows[1], rows[2], rows[3]
    truth = {r["doc_id"]: r["quality"] for r in U.read(spark, sf, "labels").collect()}
    judged = [i for i in rows[0] if truth.get(i) is not None]
    assert sum((i in good) == bool(truth[i]) for i in judged) > 0.97 * len(judged)
    table = near([(i, r["text"]) for i, r in good.items()], 5)
    assert sorted(single) == sorted(i for i, n, c in table if i == c)
    items = [(r["item_id"], r["text"]) for r in U.read(spark, sf, "benchmark").collect()]
    assert sorted(clean) == sorted(b[0] for b in contaminated([(i, r["text"]) for i, r in single.items()], items) if not b[5])
    times = Counter(r["doc_id"] for r in frames[4].collect())
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for i, r in clean.items()}
    assert set(times) <= set(clean) and max(times.values()) <= 2
    words = sum(size[i] * n for i, n in times.items())
    assert abs(words - 1.5 * sum(size.values())) < 0.15 * sum(size.values())
    tokens = frames[5].orderBy("start").collect()
    assert Counter(r["doc_id"] for r in tokens) == times
    assert [r["start"] for r in tokens[1:]] == [r["start"] + r["n_tokens"] for r in tokens[:-1]]


def test_run_is_the_query(spark, sf):
    from chirpscope.llm.queries import QUERIES
    assert QUERIES["pipeline"](spark, sf).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]

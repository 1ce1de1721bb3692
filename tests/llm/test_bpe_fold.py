import hashlib
import struct

import pytest
from pyspark.sql import functions as F

from chirpscope.llm import bpe_fold as B
from tests.llm.conftest import docs_frame


@pytest.fixture(scope="module")
def vocabulary(spark):
    return B.Vocabulary(B.multi_bpe())


@pytest.fixture(scope="module")
def library(vocabulary):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=B.word_pattern(), mergeable_ranks=vocabulary.ranks, special_tokens={})


def want(library, text):
    ids = library.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_odd_rows_match_the_library(spark, odd, odd_rows, library):
    more = [(20, "x" * 300 + "   \t\n  end  ", None, None), (21, "aaaaaaaaaaaaaaaaaaaaaaa" * 5, None, None),
            (22, "don't we'll I'd it's they're 12345678 ١٢", None, None), (23, "﻿​\u0085  x", None, None)]
    rows = odd.union(docs_frame(spark, more))
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in B.round_trip(rows).collect()), key=repr)
    assert got == sorted(((r[0], *want(library, r[1])) for r in odd_rows + more), key=repr)


def test_words_fold_like_the_library(spark, vocabulary, library):
    import random
    draw = random.Random(5)
    words = {"".join(draw.choice("aeinrstloéèü中日bcd") for _ in range(draw.randint(1, 24))) for _ in range(1500)}
    words |= {t.decode() for t in list(vocabulary.ranks)[300:40_000:97] if t.isascii() and t.strip()}
    df = spark.createDataFrame([(w,) for w in sorted(words)], "w string")
    for r in df.select("w", vocabulary.word_ids(F.col("w")).alias("ids")).collect():
        assert r["ids"] == (library._encode_single_piece(r["w"].encode()) if r["w"].encode() not in vocabulary.ranks
                            else [vocabulary.ranks[r["w"].encode()]])


def test_the_cache_changes_no_id(spark, odd, vocabulary):
    text, pattern = F.col("text"), B.word_pattern()
    cache = B.cached_words(odd, vocabulary, pattern, n_words=40)
    rows = odd.select(vocabulary.text_ids(text, pattern, cache).alias("a"), vocabulary.text_ids(text, pattern).alias("b"),
                      F.exists(B.words(text, pattern), lambda w: cache(w).isNotNull()).alias("hit"),
                      F.exists(B.words(text, pattern), lambda w: cache(w).isNull()).alias("miss")).collect()
    assert all(r["a"] == r["b"] for r in rows) and any(r["hit"] for r in rows) and any(r["miss"] for r in rows)


def test_decoding(spark, vocabulary):
    df = spark.createDataFrame([([0, 5],), ([],), ([10 ** 6],), (None,)], "ids array<int>")
    pieces = {r: t for t, r in vocabulary.ranks.items()}
    assert [r[0] for r in df.select(vocabulary.decode(F.col("ids"))).collect()] == [pieces[0] + pieces[5], b"", None, None]


def test_empty_table(spark, nothing):
    assert B.round_trip(nothing).collect() == []


def test_a_vocabulary_with_tokens_that_no_merge_gives(spark, tmp_path):
    import base64
    tokens = [bytes([b]) for b in range(256)] + [b"xyz", b"ab"]
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % k for k, t in enumerate(tokens)))
    v = B.Vocabulary(str(path))
    df = spark.createDataFrame([("xyz",), ("xyzab",), ("ab",)], "w string")
    assert [r[0] for r in df.select(v.word_ids(F.col("w"))).collect()] == [[256], [120, 121, 122, 257], [257]]


def test_the_cache_is_put_together_as_text(spark, vocabulary):
    known = B.bucketed(iter([(0, '"a":[1]'), (0, '"b\\"":[2,3]'), (2, '"c":[]')]), 3, "map<string,array<int>>")
    assert spark.range(1).select(known).head()[0] == [{"a": [1], 'b"': [2, 3]}, None, {"c": []}]
    odd = ['"', "\\", "{}", "\\n", "\u0000", " ", ",", ":\"", "é́", "\U0001F600"]
    words = spark.createDataFrame([(w,) for w in odd], "text string")
    cache = B.cached_words(words, vocabulary, r"[\s\S]+", n_words=len(odd))
    for r in words.select("text", cache(F.col("text")).alias("got"), vocabulary.word_ids(F.col("text")).alias("want")).collect():
        assert r["got"] == r["want"] and r["want"], r["text"]

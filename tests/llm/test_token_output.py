import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chirpscope.llm import token_output as T


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(T.byte_bpe())
    t.encode_special_tokens = True
    return t


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 31)), max_size=700), st.sampled_from([(0.5,), (0.9,), T.PERCENTILES]))
def test_blocks_round_trip(ids, percentiles):
    payload, starts = T.pack(np.array(ids, np.int64), percentiles=percentiles)
    assert T.unpack(np.frombuffer(payload, np.uint8), starts[:-1], len(ids)).tolist() == ids if ids else payload == b""


def test_segment_reads_any_range():
    ids = np.random.default_rng(1).integers(0, 50_000, 1000)
    s = T.Segment(T.write_segment(pa.array([5, None]), np.array([400, 600]), ids))
    assert s.doc_ids.to_pylist() == [5, None] and s.counts.tolist() == [400, 600]
    for a, b in ((0, 1000), (127, 129), (999, 5000), (300, 300)):
        assert s.read_range(a, b).tolist() == ids[a:b].tolist()


PIECES = ["a", "Z", " ", "  ", "\n", "\t", ".", ",", "'", "'s", "'ll", "é", "ß", " ", "　", " ", "—", "日", "7", "<|endoftext|>",
          "the", "\r", "\x1c", "\U0001F600", "×", "!", "-"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), max_size=4))
def test_pieces_give_the_tokenizers_own_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(T.byte_bpe())
    t.encode_special_tokens = True
    ids, counts = T.Encoder(T.byte_bpe())(pa.array(texts, pa.string()))
    want = [e.ids + [0] for e in t.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_files_hold_every_document(spark, odd, odd_rows, tokenizer):
    got = T.token_output(odd, T.byte_bpe()).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 10]
    at = 0
    texts = {r[0]: r[1] or "" for r in odd_rows}
    for r in got:
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_ids_and_empty_table(spark, odd, nothing, tokenizer, tmp_path):
    path = str(tmp_path / "tokens")
    T.write_tokens(odd.filter("doc_id in (1, 9)"), T.byte_bpe(), path)
    rows = {r["doc_id"]: r["ids"] for r in T.read_tokens(spark, path, digest=False).collect()}
    assert rows[9] == tokenizer.encode("one", add_special_tokens=False).ids + [0]
    assert T.token_output(nothing, T.byte_bpe()).collect() == []

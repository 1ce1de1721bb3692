"""Registered queries on the smallest driver tables: DuckDB twins where there are any, contracts elsewhere."""

import zlib

import pytest

from chirpscope.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    from tests.oracle_harness import duck
    return duck(sf)


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if n != "pipeline"))
def test_query_matches_oracle(spark, con, sf, name):
    from tests.oracle_harness import compare
    info = compare(spark, con, name, QUERIES[name], ORACLE[name], sf)
    assert info["ok"], info


def test_one_query_for_each_operator():
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{k}" for k in range(1, 14))}
    assert len(QUERIES) == 14


def test_held_out_flags(spark, sf):
    for name, mod, rest in (("op1_language_crf", 5, 0), ("op3_quality", 4, 2)):
        rows = QUERIES[name](spark, sf).collect()
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % mod == rest) and 0 <= r["score"] <= 1 for r in rows)

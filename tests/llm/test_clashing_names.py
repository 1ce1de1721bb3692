"""Stages of the pipeline on documents whose columns bear the names that the stages use themselves."""

import pytest

from chirpscope.llm import decontaminate, minhash_dedup, mixing, quality

NAMES = ["__key", "__text", "__score", "__n", "__times", "__k", "__id", "___key"]


@pytest.fixture(scope="module")
def frames(spark):
    good, bad = "The committee published a careful report about rivers, bridges and trade. ", "buy now !!! $$$ click "
    rows = [(k, f"{good * (1 + k % 4)} Note {k * 7919} on page {k}." if k % 3 else f"{bad * (1 + k % 5)} {k * 104729}", "en", "abc"[k % 3])
            for k in range(90)]
    rows += [rows[4], (90, rows[4][1], "en", "b"), (91, None, None, None), (None, "", "en", "a")]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    more = NAMES
    clash = spark.createDataFrame([(*r, *(f"{n}{r[0]}" for n in more)) for r in rows],
                                  plain.schema.simpleString()[7:-1].replace(":", " ") + "".join(f", {n} string" for n in more))
    return plain, clash


def stages(spark):
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(90)], "doc_id long, quality int")
    items = spark.createDataFrame([("i", "Note 87109 on page 11")], "item_id string, text string")
    return {"quality": lambda d: quality.good_documents(d, labels), "near_dedup": minhash_dedup.near_dedup,
            "decontaminate": lambda d: decontaminate.clean(d, items), "mix": mixing.mixed}


@pytest.mark.parametrize("name", ["quality", "near_dedup", "decontaminate", "mix"])
def test_same_rows_and_all_columns(spark, frames, name):
    plain, clash = frames
    stage = stages(spark)[name]
    want, got = stage(plain), stage(clash)
    assert got.columns == clash.columns and want.columns == plain.columns
    rows = got.collect()
    assert rows and all(r["__key"] == f"__key{r['doc_id']}" and r["__n"] == f"__n{r['doc_id']}" for r in rows)
    if name != "mix":                                       # the draw depends on the rows' columns
        assert sorted(map(repr, got.select(*plain.columns).collect())) == sorted(map(repr, want.collect()))
        assert name == "near_dedup" or len(rows) < clash.count()


def test_own_names_avoid_any_case(spark):
    from chirpscope.llm import common as U
    df = spark.createDataFrame([(1, 2)], "__KEY int, ___key int")
    assert U.free_names(df, "__key", "__key", "x") == ["____key", "_____key", "x"]

import pytest
from pyspark.sql import functions as F

from chirpscope.operators import bloom as B


@pytest.fixture()
def always(monkeypatch):
    monkeypatch.setattr(B, "MIN_KEYS", 0)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_same_rows_as_a_left_anti_join(spark, always):
    keys = spark.range(0, 3000, 3).select(F.col("id").alias("k")).union(spark.createDataFrame([(None,), (-9,), (0,)], "k long"))
    batch = spark.range(-50, 4000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("_x"))
    batch = batch.union(batch.limit(60)).union(spark.createDataFrame([(None, "n")], "k long, _x string"))
    assert _rows(B.anti_join(batch, keys, "k")) == _rows(batch.join(keys, on="k", how="left_anti"))
    assert _rows(B.anti_join(batch, keys.limit(0), "k")) == _rows(batch)
    assert _rows(B.anti_join(batch.limit(0), keys, "k")) == []


def test_keys_of_two_columns(spark, always):
    keys = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, t string")
    batch = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "b", 3), (3, None, 4), (9, "z", 5)], "k long, t string, n int")
    assert _rows(B.anti_join(batch, keys, ["k", "t"])) == _rows(batch.join(keys, on=["k", "t"], how="left_anti"))


def test_no_key_is_lost_and_few_new_ones_are_held(spark):
    keys = spark.range(20_000).select("id")
    words = B.bloom_words(keys, ["id"], B.filter_bits(20_000))
    shares = spark.range(40_000).select((F.col("id") < 20_000).alias("known"), B.might_hold(words, spark, ["id"]).alias("m"))
    got = {r["known"]: r["s"] for r in shares.groupBy("known").agg(F.avg(F.col("m").cast("int")).alias("s")).collect()}
    assert got[True] == 1.0 and got[False] < 0.02


def test_new_rows_skip_the_shuffle(spark, always):
    """The anti join's side of the batch holds only rows that the filter lets through."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = spark.range(5000).select(F.col("id").alias("k"))
        batch = spark.range(4900, 30_000).select(F.col("id").alias("k"))
        out = B.anti_join(batch, keys, "k")
        assert out.count() == 25_000
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" in plan and plan.count("LeftAnti") == 1
        assert plan.index("Union") < plan.index("LeftAnti")
        words = B.bloom_words(keys, ["k"], B.filter_bits(5000))
        assert batch.filter(B.might_hold(words, spark, ["k"])).count() < 700
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

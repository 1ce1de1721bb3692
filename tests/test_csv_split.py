import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpscope.sources import csv_split as CS
from chirpscope.sources.readers import CSV_OPTIONS

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.IntegerType())])


def _write(path, rows, end="\n", last=True):
    quoted = ['"' + t.replace('"', '""') + '"' if t is not None else "" for _, t, _ in rows]
    body = end.join(["id,text,n", *[f"{i},{q},{n if n is not None else ''}" for (i, _, n), q in zip(rows, quoted)]])
    path.write_bytes((body + (end if last else "")).encode())


@pytest.fixture()
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _rows(n=1200, seed=3):
    draw = random.Random(seed)
    bits = ["a", "b,c", "\n", "\n\n", '"', '""', "é", " ", "word", ",", "😀", '"\n"']
    out = [(i, "".join(draw.choices(bits, k=draw.randint(1, 12))), draw.choice([None, 1, 2])) for i in range(n)]
    out[50] = (50, "long\n" * 900 + '"end', 7)                  # one record over several blocks
    out[51] = (51, None, 8)
    return out


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    rows = _rows()
    for name, end, last in (("x.csv", "\n", True), ("y.csv", "\n", False)):
        _write(tmp_path / name, rows, end, last)
        path = str(tmp_path / name)
        lines = CS._lines(spark, path)
        assert lines.select("block").distinct().count() > 20 and lines.rdd.getNumPartitions() > 20
        got = CS.read_csv(spark, path, SCHEMA, CSV_OPTIONS)
        assert sorted(map(tuple, got.collect())) == rows
        whole = spark.read.schema(SCHEMA).options(**CSV_OPTIONS).csv(path)
        assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()


def test_several_files_and_carriage_returns(spark, tmp_path, small_blocks):
    a, b = _rows(300, 1), _rows(200, 2)
    _write(tmp_path / "a.csv", a, "\r\n")
    _write(tmp_path / "b.csv", b)
    (tmp_path / "c.csv").write_text("id,text,n\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text("id,text,n\n\n7,\"x\",1\n\n")
    got = sorted(map(tuple, CS.read_csv(spark, str(tmp_path), SCHEMA, CSV_OPTIONS).collect()), key=repr)
    assert got == sorted(a + b + [(7, "x", 1)], key=repr)


def test_malformed_files_fail(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('id,text,n\n1,"never closed,2\n3,x,4\n')
    with pytest.raises(ValueError, match="not closed"):
        CS.read_csv(spark, str(path), SCHEMA, CSV_OPTIONS)
    path = tmp_path / "bad.csv"
    path.write_text('id,text,n\nnot a number,"x",2\n')
    with pytest.raises(Exception):
        CS.read_csv(spark, str(path), SCHEMA, CSV_OPTIONS).collect()
    path = tmp_path / "head.csv"
    path.write_text('id,other,n\n1,"x",2\n')
    with pytest.raises(Exception, match="header"):
        CS.read_csv(spark, str(path), SCHEMA, CSV_OPTIONS).collect()


def test_no_file_content(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert CS.read_csv(spark, str(tmp_path), SCHEMA, CSV_OPTIONS).collect() == []
    assert CS.read_csv(spark, str(tmp_path), SCHEMA, CSV_OPTIONS).agg(F.count("*")).head()[0] == 0

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chirpscope import schemas as S
from chirpscope.session import scratch_path
from chirpscope.sources.commit_log import CommitLog
from chirpscope.sources.writers import insert_if_new, read_committed
from chirpscope.streaming import incremental as I


def raw(spark, rows):
    return spark.createDataFrame([(i, None, t, None, None, None, None) for i, t in rows], S.RAW_POST).coalesce(1)


@pytest.fixture()
def ingest(spark):
    src, target, checkpoint = (scratch_path(spark, x) for x in ("in", "out", "checkpoint"))
    schema = raw(spark, []).schema

    def put(rows):
        raw(spark, rows).write.mode("append").parquet(src)

    def run():
        return I.stream_ingest(I.file_stream(spark, src, schema, max_files=1), target, checkpoint)

    return put, run, target, checkpoint


def table(spark, target):
    return sorted((r["tweet_id"], r["tweet_text"]) for r in read_committed(spark, target).collect())


def test_keys_of_the_target_are_read_once(spark, ingest, monkeypatch):
    put, run, target, checkpoint = ingest
    columns = I.flatten_records(raw(spark, [])).columns
    insert_if_new(spark, I.flatten_records(raw(spark, [(1, "old"), (2, "old")])).select(*columns), target)
    put([(2, "new"), (3, "new"), (3, "again")])
    assert run() == 3
    put([(1, "late"), (4, "new"), (3, "late")])
    read = []
    inner = CommitLog.read
    monkeypatch.setattr(CommitLog, "read", lambda self, commits=None: read.append([c["version"] for c in commits or []]) or inner(self, commits))
    assert run() == 3
    monkeypatch.undo()
    assert read[1:] == [[]]              # the batch itself reads no committed folder
    got = table(spark, target)
    assert [k for k, _ in got] == [1, 2, 3, 4] and got[0][1] == got[1][1] == "old"


def test_another_writer_in_between(spark, ingest):
    put, run, target, checkpoint = ingest
    put([(1, "stream")])
    assert run() == 1
    insert_if_new(spark, I.flatten_records(raw(spark, [(1, "x"), (2, "x")])), target)
    put([(2, "stream"), (3, "stream")])
    assert run() == 2
    assert table(spark, target) == [(1, "stream"), (2, "x"), (3, "stream")]


def test_a_batch_run_again_after_a_crash_adds_nothing(spark, ingest, monkeypatch):
    put, run, target, checkpoint = ingest
    put([(1, "a"), (2, "a")])
    inner = CommitLog.append_new

    def dies(self, *args):                # committed, but the stream ends before its checkpoint
        inner(self, *args)
        raise RuntimeError("ended")

    monkeypatch.setattr(CommitLog, "append_new", dies)
    with pytest.raises(Exception, match="ended"):
        run()
    monkeypatch.undo()
    assert run() == 2
    put([(2, "b"), (3, "b")])
    assert run() == 2
    assert table(spark, target) == [(1, "a"), (2, "a"), (3, "b")]
    assert [c["rows"] for c in CommitLog(spark, target).commits()] == [2, 1]


def test_closed_days_and_late_rows(spark):
    src, target, checkpoint = (scratch_path(spark, x) for x in ("ev", "days", "days-checkpoint"))

    def put(rows):
        spark.createDataFrame([(dt.datetime(2024, 1, d, h), v) for d, h, v in rows], "ts timestamp_ntz, value double").coalesce(1).write.mode("append").parquet(src)

    def run():
        return I.stream_closed_days(I.file_stream(spark, src, spark.createDataFrame([], "ts timestamp_ntz, value double").schema, max_files=1),
                                    target, checkpoint)

    def days():
        return sorted((r["date"].day, r["avg_value"], r["n"]) for r in spark.read.parquet(target).collect())

    put([(1, 3, 1.0), (1, 9, 2.0), (2, 0, float("nan"))])
    put([(3, 1, 5.0), (1, 23, 6.0), (2, 2, 4.0)])
    assert run() == {"rows": 6, "late": 0, "open": 2}      # the third day's rows closed the first day
    assert days() == [(1, 3.0, 3)]
    put([(4, 1, 1.0)])                    # closes the second day
    put([(1, 4, 100.0), (1, 5, 100.0), (3, 2, 7.0), (6, 0, 1.0)])
    out = run()
    assert out["late"] == 2 and out["rows"] == 5
    assert days()[:2] == [(1, 3.0, 3), (2, 4.0, 2)]
    put([(20, 0, 1.0)])
    run()
    assert days()[:5] == [(1, 3.0, 3), (2, 4.0, 2), (3, 6.0, 2), (4, 1.0, 1), (6, 1.0, 1)]


def test_one_call_looks_up_many_keys(spark, ingest, monkeypatch):
    """Keys of one part of the state: new, in the target, repeated in a batch and in a later one."""
    from chirpscope.streaming import seen_keys
    monkeypatch.setattr(seen_keys, "KEY_PARTS", 2)
    put, run, target, checkpoint = ingest
    insert_if_new(spark, I.flatten_records(raw(spark, [(k, "old") for k in range(0, 40, 4)])), target)
    put([(k, "one") for k in range(30)] + [(k, "one") for k in range(10)])
    assert run() == 40
    put([(k, "two") for k in range(20, 50)])
    assert run() == 30 and run() == 0
    want = {k: "one" if k < 30 else "two" for k in range(50)} | {k: "old" for k in range(0, 40, 4)}
    assert table(spark, target) == sorted(want.items())
    state = spark.read.format("statestore").option("stateVarName", "seen").load(checkpoint)
    assert state.count() == 2            # one value a part, not one a key

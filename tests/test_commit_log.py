import threading

import pytest
from pyspark.sql import functions as F

from chirpscope.session import scratch_path
from chirpscope.sources.commit_log import CommitLog


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def test_two_writers_of_one_key_leave_one_row(spark):
    path = scratch_path(spark, "log")
    a, b = CommitLog(spark, path), CommitLog(spark, path)
    staged = []

    claim = b.claim

    def late(version, commit):            # the other writer commits between this one's read and its claim
        if not staged:
            staged.append(a.insert(frame(spark, [(1, "a"), (2, "a")]), "k"))
        return claim(version, commit)

    b.claim = late
    assert b.insert(frame(spark, [(2, "b"), (3, "b")]), "k") == {"inserted": 1, "skipped": 1}
    assert staged == [{"inserted": 2, "skipped": 0}]
    assert sorted(map(tuple, a.read().collect())) == [(1, "a"), (2, "a"), (3, "b")]


def test_many_writers_at_once(spark):
    path = scratch_path(spark, "log-many")
    out = []

    def write(n):
        out.append(CommitLog(spark, path).insert(frame(spark, [(k, str(n)) for k in range(n, n + 4)]), "k"))

    threads = [threading.Thread(target=write, args=(n,)) for n in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    keys = [r["k"] for r in CommitLog(spark, path).read().collect()]
    assert sorted(keys) == list(range(8)) and sum(o["inserted"] for o in out) == 8 and len(out) == 5


def test_a_version_is_granted_once(spark):
    path = scratch_path(spark, "log-claim")
    won = []
    threads = [threading.Thread(target=lambda n=n: won.append(CommitLog(spark, path).claim(0, {"folder": None, "batch": n}))) for n in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert won.count(True) == 1 and len(CommitLog(spark, path).commits()) == 1


def test_a_repeated_batch_adds_nothing(spark):
    path = scratch_path(spark, "log-again")
    log = CommitLog(spark, path)
    first = log.insert(frame(spark, [(1, "a"), (1, "b"), (2, "c")]), "k", [F.col("v")], batch_id="x#0")
    again = log.insert(frame(spark, [(1, "a"), (5, "z")]), "k", batch_id="x#0")
    assert first == {"inserted": 2, "skipped": 1} and again == first | {"repeated": True}
    assert sorted(map(tuple, log.read().collect())) == [(1, "a"), (2, "c")]


def test_a_writer_that_ends_before_its_commit_leaves_nothing(spark):
    path = scratch_path(spark, "log-ended")
    log = CommitLog(spark, path)
    log.insert(frame(spark, [(1, "a")]), "k")

    def ended(version, commit):
        raise KeyboardInterrupt

    dying = CommitLog(spark, path)
    dying.claim = ended
    with pytest.raises(KeyboardInterrupt):
        dying.insert(frame(spark, [(2, "b")]), "k", batch_id="y#0")
    assert [tuple(r) for r in log.read().collect()] == [(1, "a")]
    assert log.insert(frame(spark, [(2, "b")]), "k", batch_id="y#0") == {"inserted": 1, "skipped": 0}
    assert sorted(map(tuple, log.read().collect())) == [(1, "a"), (2, "b")]


def test_empty_batches(spark):
    path = scratch_path(spark, "log-empty")
    log = CommitLog(spark, path)
    assert log.read() is None
    assert log.insert(frame(spark, []), "k") == {"inserted": 0, "skipped": 0}
    assert log.read().collect() == [] and log.read().columns == ["k", "v"]
    assert log.insert(frame(spark, [(None, "n"), (None, "n"), (1, "x")]), "k") == {"inserted": 2, "skipped": 1}

"""Structured Streaming forms of the incremental steps.

* ``stream_ingest``   — idempotent ingest: every unseen key is inserted however late
  it arrives, seen keys are ignored (keyed state, committed to a ``CommitLog``; no
  watermark, which would drop late posts).
* ``stream_scoring``  — lexicon scoring of unseen posts, committed per micro-batch.
* ``stream_daily_trend`` — mean value per 1-day tumbling window; each micro-batch
  rewrites the days it changed.
* ``stream_closed_days`` — the same with a watermark: a day is written once, when it is
  closed, its state goes, and rows that come later are counted.

All run with ``trigger(availableNow=True)`` so a test or a scheduled job drains
what is there and stops.  The caller names the checkpoint location: with the same
location the next run reads only new files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpscope.operators.ingest import flatten_records
from chirpscope.operators.sentiment import score_lexicon
from chirpscope.sources.commit_log import CommitLog
from chirpscope.streaming.seen_keys import DailyMeans, keyed_state, unseen_rows


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None,
                fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder)


def run_available(stream: DataFrame, batch_fn: Callable[[DataFrame, int], None], checkpoint_location: str,
                  output_mode: str = "append", progress: dict | None = None) -> int:
    """Drain the stream through ``batch_fn`` and stop; the number of source rows read by this run.
    ``progress`` receives the rows that the watermark kept out (``late``) and the state's keys at the
    end (``open``)."""
    q = (stream.writeStream.outputMode(output_mode).foreachBatch(batch_fn)
         .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    every = q.recentProgress
    if progress is not None:
        states = [s for p in every for s in p["stateOperators"]]
        progress["late"] = sum(int(s["numRowsDroppedByWatermark"]) for s in states)
        progress["open"] = int(states[-1]["numRowsTotal"]) if states else 0
    return sum(int(s["numInputRows"]) for p in every for s in p["sources"])


def stream_ingest(raw_stream: DataFrame, target: str, checkpoint_location: str, key: str = "tweet_id",
                  order: Sequence[str] = ()) -> int:
    """Flatten, keep the first row of every key that the table ``target`` lacks, commit it (STR1);
    of a key repeated in a micro-batch the first by the ``order`` columns of the stream.  Rows
    without a key are left out.  Returns the rows read."""
    rows = flatten_records(raw_stream, keep=order)
    return _insert_unseen(rows, target, checkpoint_location, key, order, lambda df: df)


def stream_scoring(posts_stream: DataFrame, lexicon: DataFrame, target: str, checkpoint_location: str,
                   key: str = "tweet_id", order: Sequence[str] = ()) -> int:
    """The first row of every key not yet in ``target``, scored and committed (STR2).  Returns the
    rows read."""
    return _insert_unseen(posts_stream, target, checkpoint_location, key, order,
                          lambda df: score_lexicon(df, lexicon, id_col=key))


def _insert_unseen(rows: DataFrame, target: str, checkpoint_location: str, key: str, order: Sequence[str],
                   finish: Callable[[DataFrame], DataFrame]) -> int:
    """Rows of unseen keys, committed batch by batch under names of their own.  The keys of ``target``
    are read once, into the state of the first batch; from then on a batch costs its own keys' state
    and what other writers committed."""
    spark = rows.sparkSession
    log, writer = CommitLog(spark, target), checkpoint_location.rstrip("/")
    base = log.base_of(writer)
    if base is None:
        known = log.commits()
        base = known[-1]["version"] if known else -1
    before = log.read([c for c in log.commits() if c["version"] <= base])
    unseen = unseen_rows(rows.where(F.col(key).isNotNull()), key, order, None if before is None else before.select(key))

    def batch(df: DataFrame, epoch: int) -> None:
        log.append_new(finish(df), key, f"{writer}#{epoch}", writer, base)

    with keyed_state(spark):
        return run_available(unseen, batch, checkpoint_location)


def stream_daily_trend(events: DataFrame, target: str, checkpoint_location: str, ts_col: str = "ts",
                       value_col: str = "value", digits: int = 6) -> int:
    """Mean value per 1-day tumbling window (STR3), in update mode: a micro-batch yields the days
    that it changed, and each replaces its own partition ``date=…`` of ``target``.  The state is
    one row a day, so no watermark is needed to bound it and late rows always count.  Returns the
    rows read."""
    v = F.when(F.isnan(F.col(value_col)), F.lit(None)).otherwise(F.col(value_col))
    agg = (events.where(F.col(ts_col).isNotNull())
           .groupBy(F.window(F.col(ts_col).cast("timestamp"), "1 day").alias("w"))
           .agg(F.avg(v).alias("_avg")))

    def batch(df: DataFrame, epoch: int) -> None:
        (df.select(F.to_date(F.col("w.start")).alias("date"), F.round("_avg", digits).alias("avg_value"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(target))

    return run_available(agg, batch, checkpoint_location, "update")


def stream_closed_days(events: DataFrame, target: str, checkpoint_location: str, delay: str = "2 days", ts_col: str = "ts",
                       value_col: str = "value", digits: int = 6) -> dict:
    """Mean value per day (STR3) with bounded state: a day closes once the stream has seen a row
    ``delay`` past its end, and is then appended to ``target`` (date, avg_value, n).  Rows of a closed
    day are late: they change nothing and are counted.  Returns {"rows", "late", "open"}: rows read
    and late rows of this run, and days still open."""
    spark = events.sparkSession
    value = F.when(F.isnan(F.col(value_col)), F.lit(None)).otherwise(F.col(value_col)).cast("double")
    day = F.date_trunc("day", F.col(ts_col).cast("timestamp"))
    # the event time of a row is the end of its day: a row is late exactly if its day is closed
    rows = (events.where(F.col(ts_col).isNotNull())
            .select(day.cast("date").alias("date"), value.alias("value"), (day + F.expr("INTERVAL 1 DAY")).alias("ends"))
            .withWatermark("ends", delay))
    closed = rows.groupBy("date").transformWithStateInPandas(
        DailyMeans(digits), "date date, avg_value double, n long", "Append", "EventTime")
    seen: dict = {}

    def batch(df: DataFrame, epoch: int) -> None:
        (df.withColumn("batch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(target))                    # a batch run again replaces itself

    with keyed_state(spark):
        n = run_available(closed, batch, checkpoint_location, progress=seen)
    return {"rows": n, "late": seen["late"], "open": seen["open"]}

"""Writers: CSV exports, appends, insert-if-new, stamped summary rows, latest text.

Every writer raises on failure.  Paths are expected in a shared file system
(use ``chirpscope.session.scratch_path`` for intermediate tables).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpscope.sources.commit_log import CommitLog
from chirpscope.sources.readers import CSV_OPTIONS, table_exists


def _csv_out_options() -> dict:
    return {k: v for k, v in CSV_OPTIONS.items() if k not in ("multiLine", "mode")}


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV overwrite with header (SNK1).  ``single_file`` only for small top-k tables."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**_csv_out_options()).csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    """CSV append (SNK2): each part file carries its own header line."""
    df.write.mode("append").options(**_csv_out_options()).csv(path)


def export_network(paths: dict[str, str], mention_edges: DataFrame, hashtag_edges: DataFrame,
                   nodes: DataFrame, top_accounts: DataFrame, top_hashtags: DataFrame) -> None:
    """The five network exports (SNK3); an empty edge table is not written."""
    if mention_edges.limit(1).count():
        write_csv(mention_edges, paths["mention_edges"])
    if hashtag_edges.limit(1).count():
        write_csv(hashtag_edges, paths["hashtag_edges"])
    write_csv(nodes, paths["nodes_metrics"])
    write_csv(top_accounts, paths["top_accounts"], single_file=True)
    write_csv(top_hashtags, paths["top_hashtags"], single_file=True)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Plain append to a parquet table (SNK6)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def create_table_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Create an empty parquet table with the declared schema unless it exists (SNK9)."""
    if table_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
    return True


def insert_if_new(spark: SparkSession, batch: DataFrame, path: str, key: str = "tweet_id", order=(),
                  batch_id: str | None = None, followers: Sequence[Callable[[CommitLog], object]] = ()) -> dict:
    """Commit the batch rows whose key is not in the table at ``path`` yet; of a key repeated in the
    batch the first in ``order`` (SNK4, SNK5).  Returns true counts.

    The table is a ``CommitLog``: two writers of one key leave one row, and a batch named by
    ``batch_id`` is taken once however often it is written.  Read it with ``read_committed``.
    ``followers`` (``SearchIndex``, ``ZoneMap``, or a function that gives such an object for the table) are
    brought up to date after the commit; a writer that ends before leaves that to the next one."""
    table = CommitLog(spark, path)
    done = table.insert(batch, key, order, batch_id)
    for follower in followers:
        follower(table).refresh()
    return done


def read_committed(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a table that ``insert_if_new`` fills; None if nothing was committed."""
    return CommitLog(spark, path).read()


def append_summary(spark: SparkSession, summary: DataFrame, path: str) -> None:
    """Append summary rows stamped with the insert time (SNK7, FN19)."""
    (summary.select(F.col("summary").cast("string"), F.current_timestamp().alias("generated_at"))
     .write.mode("append").parquet(path))


def write_latest_text(summary: DataFrame, path: str) -> None:
    """Overwrite the "latest" text output with the single summary text (SNK8)."""
    summary.select(F.col("summary").alias("value")).coalesce(1).write.mode("overwrite").text(path)


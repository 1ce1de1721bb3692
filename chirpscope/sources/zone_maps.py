"""Newest rows through zone maps (SRC5, SRT1, SRT2): each file's first and last time.

The k files with the latest first times (each holds a row at least) give a time that k rows are
not older than.  Only files whose last time reaches it can hold one of the newest k; the rest
is not opened.  Where batches come in the order of time, that is a few files at any table size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpscope import constants as C
from chirpscope.operators.summarize import newest_k
from chirpscope.sources.commit_log import CommitLog
from chirpscope.sources.derived import Derived, folder_name


def zones(rows: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """(folder, file, lo, hi, n) of each file: first and last time, rows that have a time."""
    return rows.groupBy(folder_name().alias("folder"), F.col("_metadata.file_name").alias("file")).agg(
        F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi"), F.count(ts_col).alias("n"))


class ZoneMap:
    """The zone map of one table."""

    def __init__(self, table: CommitLog, ts_col: str = "created_at", id_col: str = "tweet_id"):
        self.table, self.ts_col, self.id_col = table, ts_col, id_col
        self.derived = Derived(table, f"zones-{ts_col}", lambda rows: zones(rows, ts_col))

    def refresh(self) -> int:
        return self.derived.refresh()

    def files_of_newest(self, k: int, derived: list[dict]) -> list[str] | None:
        """Files that can hold one of the newest ``k`` rows; None if fewer than ``k`` rows have a time
        (then any file can)."""
        z = self.derived.log.read(derived).where(F.col("n") > 0)
        rows = 0
        for zone in z.orderBy(F.col("lo").desc()).limit(k).collect():           # at most k rows
            rows += zone["n"]
            if rows >= k:
                near = z.where(F.col("hi") >= F.lit(zone["lo"]).cast(z.schema["hi"].dataType)).select("folder", "file")
                return [f"{self.table.path}/data/{r['folder']}/{r['file']}" for r in near.collect()]
        return None

    def newest(self, k: int = C.NEWEST_K) -> DataFrame | None:
        """``newest_k`` over the whole table; None if nothing was committed."""
        seen, table = self.derived.snapshot(), self.table.read()
        if table is None:
            return None
        files = self.files_of_newest(k, seen.derived) if seen.derived and k > 0 else None
        if files is None:
            return newest_k(table, self.ts_col, self.id_col, k)
        files += self.table.folders(seen.pending)
        return newest_k(self.table.spark.read.schema(table.schema).parquet(*files), self.ts_col, self.id_col, k)

"""Dashboard aggregates from mergeable partials (AGG3, AGG4, AGG6, AGG7).

Each commit leaves one row per (date, class): rows, values, their sum, extremes and the first and last
time.  Counts, sums and extremes merge, so a dashboard reads rows of days and classes instead of
posts, and a refresh reads the new commits alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpscope import constants as C
from chirpscope.sources.commit_log import CommitLog
from chirpscope.sources.derived import Derived


def partials(rows: DataFrame, ts_col: str, class_col: str, value_col: str) -> DataFrame:
    """One row per (date, class), nulls included; a NaN value counts as missing."""
    v = F.col(value_col).cast("double")
    v = F.when(~F.isnan(v), v)
    return rows.groupBy(F.to_date(ts_col).alias("date"), F.col(class_col).alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.count(v).alias("n_values"), F.sum(v).alias("total"),
        F.min(v).alias("least"), F.max(v).alias("most"), F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts"))


def _mean():
    return F.try_divide(F.sum("total"), F.sum("n_values"))


class DailyPartials:
    """The partials of one table."""

    def __init__(self, table: CommitLog, ts_col: str, class_col: str, value_col: str):
        self.derived = Derived(table, f"daily-{ts_col}-{class_col}-{value_col}",
                               lambda rows: partials(rows, ts_col, class_col, value_col))

    def refresh(self) -> int:
        return self.derived.refresh()

    def _rows(self) -> DataFrame | None:
        return self.derived.rows(self.derived.snapshot())

    def merged(self, digits: int = 6) -> DataFrame | None:
        """(date, class, n, avg_value, least, most, first_ts, last_ts); None if the table has no rows."""
        rows = self._rows()
        return None if rows is None else rows.groupBy("date", "class").agg(
            F.sum("n").alias("n"), F.round(_mean(), digits).alias("avg_value"),
            F.min("least").alias("least"), F.max("most").alias("most"),
            F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))

    def value_counts(self, name: str = "count") -> DataFrame | None:
        """Rows per class, as ``report.value_counts``."""
        rows = self._rows()
        return None if rows is None else (rows.where(F.col("class").isNotNull()).groupBy("class")
                                          .agg(F.sum("n").alias(name)).orderBy(F.col(name).desc(), F.col("class").asc()))

    def class_totals(self) -> DataFrame | None:
        """Rows in all, positive and negative ones, as ``report.class_totals``."""
        def of(label: str):
            return F.coalesce(F.sum(F.when(F.col("class") == label, F.col("n"))), F.lit(0))

        rows = self._rows()
        return None if rows is None else rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                                                  of(C.POSITIVE).alias("positive"), of(C.NEGATIVE).alias("negative"))

    def daily_mean(self, digits: int = 6, out: str = "avg_value") -> DataFrame | None:
        """Mean value per date, as ``report.daily_mean``."""
        rows = self._rows()
        return None if rows is None else (rows.where(F.col("date").isNotNull()).groupBy("date").agg(
            F.round(_mean(), digits).alias(out)).orderBy("date"))

    def date_bounds(self) -> DataFrame | None:
        """First and last date, as ``report.date_bounds``."""
        rows = self._rows()
        return None if rows is None else rows.agg(F.to_date(F.min("first_ts")).alias("min_date"),
                                                  F.to_date(F.max("last_ts")).alias("max_date"))

"""Reporting queries: filters, counts, daily trend, bounds, top-k (dashboard tabs).

All are single-pass aggregations or top-k plans; filters are written as ranges on
the raw column so they reach the parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirpscope import constants as C


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def filter_date_range(df: DataFrame, ts_col: str, start=None, end=None) -> DataFrame:
    """Calendar-date range, both ends inclusive; no filter unless both ends are set (FLT2).

    Written as ``ts >= start AND ts < end + 1 day`` on the raw timestamp (sargable)."""
    if start is None or end is None:
        return df
    s, e = _as_date(start), _as_date(end) + dt.timedelta(days=1)
    typ = df.schema[ts_col].dataType.simpleString()
    lo = F.lit(f"{s.isoformat()} 00:00:00").cast(typ)
    hi = F.lit(f"{e.isoformat()} 00:00:00").cast(typ)
    return df.where((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))


def filter_in(df: DataFrame, col: str, values: Iterable | None) -> DataFrame:
    """In-list filter; an empty or missing list means no filter (FLT3)."""
    vals = list(values or [])
    return df.where(F.col(col).isin(vals)) if vals else df


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Counts per non-null value, most frequent first, ties by value (AGG3)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), F.col(col).asc()))


def class_totals(df: DataFrame, col: str) -> DataFrame:
    """One row: total rows, positives, negatives (0 when a class is absent) (AGG4, AGG5)."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(F.col(col) == C.POSITIVE).alias("positive"),
                  F.count_if(F.col(col) == C.NEGATIVE).alias("negative"))


def daily_mean(df: DataFrame, ts_col: str, value_col: str, digits: int = 6,
               out: str = "avg_value") -> DataFrame:
    """Mean per calendar date, NaN treated as missing, null dates dropped (AGG6, FN15)."""
    v = F.when(F.isnan(F.col(value_col)), F.lit(None)).otherwise(F.col(value_col))
    return (df.where(F.col(ts_col).isNotNull())
            .groupBy(F.to_date(F.col(ts_col)).alias("date"))
            .agg(F.round(F.avg(v), digits).alias(out)).orderBy("date"))


def date_bounds(df: DataFrame, ts_col: str) -> DataFrame:
    """Global first and last calendar date (AGG7)."""
    return df.agg(F.to_date(F.min(ts_col)).alias("min_date"), F.to_date(F.max(ts_col)).alias("max_date"))


def _clean(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def top_bottom(df: DataFrame, value_col: str, id_col: str, k: int = 5,
               cols: Sequence[str] | None = None) -> DataFrame:
    """Top-k and bottom-k rows by value, NaN/null last both ways, ties by id (SRT4).

    Each side is an ``orderBy().limit()`` → TakeOrderedAndProject (per-task top-k
    then a k-row merge), never a full sort."""
    cols = list(cols or df.columns)
    v = _clean(F.col(value_col))
    top = (df.withColumn("_v", v).orderBy(F.col("_v").desc_nulls_last(), F.col(id_col).asc()).limit(k)
           .withColumn("side", F.lit("top")))
    bot = (df.withColumn("_v", v).orderBy(F.col("_v").asc_nulls_last(), F.col(id_col).asc()).limit(k)
           .withColumn("side", F.lit("bottom")))
    return top.unionByName(bot).select("side", *cols)


def top_per_class(df: DataFrame, class_col: str, value_col: str, id_col: str, k: int = 5,
                  classes: Iterable[str] | None = None) -> DataFrame:
    """Top-k rows per class by value desc, ties by id (SRT5).

    ``row_number() ≤ k`` over a class window: Catalyst inserts a partial
    WindowGroupLimit before the shuffle, so each task ships ≤ k rows per class
    even when one class holds most rows."""
    d = filter_in(df, class_col, classes)
    w = Window.partitionBy(class_col).orderBy(_clean(F.col(value_col)).desc_nulls_last(), F.col(id_col).asc())
    return d.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def latest_row(df: DataFrame, ts_col: str, id_col: str, cols: Sequence[str]) -> DataFrame:
    """The row with the greatest timestamp (ties: greatest id), as one aggregate (SRT2)."""
    r = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(ts_col), F.col(id_col)))
    return df.agg(r.alias("_r")).select(*[F.col(f"_r.{c}").alias(c) for c in cols])


def display_line(text_col: str, value_col: str, fmt: str = "%.2f") -> Column:
    """``text (score=0.97)`` display string (FN16)."""
    return F.format_string(f"%s (score={fmt})", F.col(text_col), F.col(value_col))

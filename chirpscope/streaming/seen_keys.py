"""State of the incremental streams: keys seen, and open days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB: on disk, with changes checkpointed."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Parts that the keys are dealt to by their hash; a part's keys are one value of the state, so a call
#: of the processor looks up all keys of a batch that fall in it.  Fixed for the life of a checkpoint.
KEY_PARTS = 1 << 13


class FirstOfKeys(StatefulProcessor):
    """The first row, by the ``order`` columns, of each key of a part that the state does not hold."""

    def __init__(self, columns: Sequence[str], key: str, key_type: T.DataType, order: Sequence[str]):
        self.columns, self.key, self.key_type, self.order = list(columns), key, key_type, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("keys", T.ArrayType(self.key_type))]))

    def _known(self) -> list:
        held = self.seen.get()
        return list(held[0]) if held is not None else []

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.seen.update((self._known() + [k for keys in initialState["_keys"] for k in keys],))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self._known()
        held = set(known)
        best = None
        for part in rows:                       # a part's rows come in pieces; one row a key is kept
            part = part[[k not in held for k in part[self.key].tolist()]]
            if len(part):
                part = part if best is None else pd.concat([best, part])
                if len(part) > 1:
                    part = part.sort_values(self.order, kind="stable", na_position="first") if self.order else part
                    part = part.drop_duplicates(self.key)
                best = part
        if best is not None:
            self.seen.update((known + best[self.key].tolist(),))
            yield best[self.columns]

    def close(self) -> None:
        pass


def unseen_rows(rows: DataFrame, key: str, order: Sequence[str], seen: DataFrame | None) -> DataFrame:
    """The first row of every key of the stream that is new to it and not in ``seen`` (which only the
    first micro-batch of a checkpoint reads); the ``order`` columns are dropped."""
    columns = [c for c in rows.columns if c not in order]
    schema = T.StructType([rows.schema[c] for c in columns])
    part = F.pmod(F.xxhash64(key), F.lit(KEY_PARTS)).alias("_part")
    known = None if seen is None else (seen.where(F.col(key).isNotNull()).groupBy(part)
                                       .agg(F.collect_set(key).alias("_keys")).groupBy("_part"))
    return rows.select("*", part).groupBy("_part").transformWithStateInPandas(
        FirstOfKeys(columns, key, rows.schema[key].dataType, order), schema, "Append", "None", initialState=known)


class DailyMeans(StatefulProcessor):
    """Sum and number of each open day; one row when a day closes."""

    def __init__(self, digits: int):
        self.digits = digits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", T.StructType([
            T.StructField("sum", T.DoubleType()), T.StructField("valued", T.LongType()), T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = not self.total.exists()
        total, valued, n = (0.0, 0, 0) if fresh else self.total.get()
        for part in rows:
            total += float(part["value"].sum())
            valued += int(part["value"].notna().sum())
            n += len(part)
        self.total.update((total, valued, n))
        if fresh:
            ends = dt.datetime.combine(key[0] + dt.timedelta(days=1), dt.time(), dt.timezone.utc)
            self.handle.registerTimer(int(ends.timestamp() * 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total, valued, n = self.total.get()
        self.total.clear()
        mean = round(total / valued, self.digits) if valued else None
        yield pd.DataFrame({"date": [key[0]], "avg_value": pd.Series([mean], dtype="float64"), "n": [n]})

    def close(self) -> None:
        pass

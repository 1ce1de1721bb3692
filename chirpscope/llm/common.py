"""Helpers shared by the operators of this package: scratch tables, Arrow text buffers,
byte-level word cutting and 64-bit polynomial fingerprints."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpscope.session import scratch_path

#: Bytes of text that one in-task step works on.  A single longer text is a step of its own.
GROUP_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*cols) if cols else df


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of few rows: texts can be very long, and a batch is held whole in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh table in the shared scratch folder and read it back: cuts the lineage
    and outlives any executor."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a few fixed-width columns that may be broadcast (tens of megabytes).
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame) -> DataFrame:
    """A stored table of a few fixed-width columns as the small side of a join: broadcast if its
    counted rows allow it, left to a shuffle join otherwise."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def bulk(batches: Iterable[pa.RecordBatch], text_col: str,
         max_bytes: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Regroup Arrow batches so that each holds about ``max_bytes`` of ``text_col``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        lens = pc.fill_null(pc.binary_length(b.column(text_col)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < b.num_rows:
            room = np.cumsum(lens[at:])
            n = max(1 if not held else 0, int(np.searchsorted(room, max_bytes - size, "right")))
            if n:
                held.append(b.slice(at, n))
                size += int(room[n - 1])
                at += n
            if at < b.num_rows or size >= max_bytes:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and their offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) else "")
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


# --- words -------------------------------------------------------------------

#: A-Z to a-z, everything else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(pattern_bytes: Iterable[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(pattern_bytes)] = True
    return out


#: Bytes of words: digits, letters and all of non-ASCII (after lower-casing).
ALNUM = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: Bytes of words cut at white space.
NOSPACE = byte_class(x for x in range(256) if x != 0x20 and not 0x09 <= x <= 0x0D)


def word_spans(data: np.ndarray, off: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``word`` bytes (never across texts), and the
    number of words of each text."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off) - 1, np.int64)
    w = word[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    start = np.flatnonzero(w & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    end = np.flatnonzero(w & (~after | edge[1:])) + 1
    return start, end, np.diff(np.searchsorted(start, off))


# --- fingerprints ----------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = int(1.2 * n)                   # as long as the longest step so far, no longer
        for k, b in enumerate((_BASE, _INVERSE)):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x, out=x)
    return _powers[0], _powers[1]


def release() -> None:
    """Give back what earlier tasks of this worker left: power tables and pooled buffers."""
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    pa.default_memory_pool().release_unused()


class Prints:
    """Polynomial fingerprints (mod 2**64, then mixed) of any substrings of ``data`` in O(1)
    each.  Unrelated substrings agree with a probability of about 2**-64; texts made for it can agree
    (complementary Thue-Morse words of 1,024 bytes do)."""

    def __init__(self, data: np.ndarray):
        p, self.inv = _grown(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        x = data.astype(np.uint64)
        x += np.uint64(1)
        x *= p[:len(data)]
        np.cumsum(x, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inv[start])


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... start+len-1 of every range, one after the other."""
    total = int(lens.sum())
    before = np.cumsum(lens) - lens
    return np.repeat(starts - before, lens) + np.arange(total)

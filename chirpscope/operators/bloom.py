"""Anti join behind a Bloom filter: rows whose key is surely new skip the shuffle.

The keys of the target set bits of a filter: an aggregation by 64-bit word, ``bit_or`` on the map side
first, so what is shuffled and fetched is bounded by the filter's size, whatever the number of keys.
A batch row whose bits are not all set has a key that the target lacks and goes straight to the
result; only the others are joined, exactly.  Of a batch of mostly new keys little is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, hashes for each key, and the most bits of a filter (16 MB).
BITS_A_KEY = 12
HASHES = 5
MAX_BITS = 1 << 27
#: Target keys from which on the filter is worth its pass over the keys.
MIN_KEYS = 5_000_000


def filter_bits(n_keys: int) -> int:
    """A power of two, 64 at least."""
    return min(MAX_BITS, 1 << max(6, (max(1, n_keys) * BITS_A_KEY - 1).bit_length()))


def _hashes(keys: list[Column]) -> tuple[Column, Column]:
    """Two hashes; the i-th bit of a key is at the first plus i times the second."""
    return F.xxhash64(*keys), F.xxhash64(*keys, F.lit(1)).bitwiseOR(F.lit(1))


def bloom_words(keys: DataFrame, names: list[str], bits: int) -> np.ndarray:
    """The filter of the (non-null) keys as 64-bit words."""
    one, two = _hashes([F.col(k) for k in names])
    known = keys.dropna(subset=names).select((one.bitwiseAND(bits - 1)).alias("a"), (two.bitwiseAND(bits - 1)).alias("b"))
    bit = known.select(F.explode(F.array(*[(F.col("a") + F.col("b") * i).bitwiseAND(bits - 1) for i in range(HASHES)])).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(63).cast("int"))).alias("bits"))
    out = np.zeros(bits // 64, np.uint64)
    got = words.toArrow()
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def might_hold(words: np.ndarray, spark, names: list[str]) -> Column:
    """Whether the filter may hold a row's key: only the hashes of the key go to Python."""
    shared = spark.sparkContext.broadcast(words)
    mask = np.int64(len(words) * 64 - 1)

    @F.pandas_udf("boolean")
    def probe(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        table = shared.value
        for a, b in parts:
            a, b = a.to_numpy() & mask, b.to_numpy() & mask
            held = np.ones(len(a), bool)
            for i in range(HASHES):
                at = (a + b * i) & mask
                held &= (table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0
            yield pd.Series(held)

    return probe(*_hashes([F.col(k) for k in names]))


def anti_join(batch: DataFrame, target_keys: DataFrame, key: str | list[str], n_keys: int | None = None,
              min_keys: int | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target_keys``, as a left anti join gives them.  A target
    of fewer than ``min_keys`` keys (``MIN_KEYS``; counted, if not given) is joined plainly."""
    names = [key] if isinstance(key, str) else list(key)
    keys = target_keys.select(*names)
    n_keys = keys.count() if n_keys is None else n_keys
    if n_keys < (MIN_KEYS if min_keys is None else min_keys):
        return batch.join(keys, on=names, how="left_anti").select(*batch.columns)
    words = bloom_words(keys, names, filter_bits(n_keys))
    flagged = batch.withColumn("_maybe", might_hold(words, batch.sparkSession, names))
    new = flagged.filter(~F.col("_maybe")).drop("_maybe")
    rest = flagged.filter(F.col("_maybe")).drop("_maybe").join(keys, on=names, how="left_anti")
    return new.unionByName(rest.select(*batch.columns))

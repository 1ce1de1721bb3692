"""Ingest: flatten API records, search predicate, insert-if-new by key.

Insert-if-new ("first writer wins, no update") is a left-anti join of the
de-duplicated batch against the target's keys, followed by an append.  Both the
de-duplication and the anti join are shuffles on the key only; a key that is
hot in the batch is reduced map-side by the partial aggregation of the dedupe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpscope import constants as C
from chirpscope.functions import text as TX
from chirpscope.operators.bloom import anti_join


def flatten_records(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested post record → flat ``posts`` row (PRJ1, PRJ2, FN18).

    A missing metric, or a missing metrics record, becomes 0; ``sentiment`` is
    a typed null placeholder for later stages.
    """
    has_metrics = "public_metrics" in raw.columns

    def metric(name: str) -> Column:
        if not has_metrics:
            return F.lit(0).cast("int")
        return F.coalesce(F.col(f"public_metrics.{name}").cast("int"), F.lit(0))

    return raw.select(
        F.col("id").cast("long").alias("tweet_id"),
        F.col("author_id").cast("long").alias("author_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("tweet_text"),
        F.col("created_at").alias("created_at"),
        F.col("lang").alias("lang"),
        F.col("source").alias("source"),
        metric("like_count").alias("like_count"),
        metric("retweet_count").alias("retweet_count"),
        F.lit(None).cast("string").alias("sentiment"),
        *[F.col(k) for k in keep],
    )


# --- search (SRC8) -------------------------------------------------------------

def parse_search(query: str) -> dict:
    """Split a search string into plain terms and the ``lang:`` / ``-is:retweet`` operators."""
    terms, lang, no_reposts = [], None, False
    for tok in query.split():
        if tok.startswith("lang:"):
            lang = tok.split(":", 1)[1]
        elif tok == "-is:retweet":
            no_reposts = True
        else:
            terms.append(tok)
    return {"terms": terms, "lang": lang, "no_reposts": no_reposts}


def search_posts(posts: DataFrame, query: str = C.DEFAULT_SEARCH,
                 max_results: int | None = None,
                 is_repost: Column | None = None) -> DataFrame:
    """Posts matching every term (case-insensitive whole word).  ``max_results`` (off by
    default) keeps the newest so many."""
    q = parse_search(query)
    out = posts
    if q["lang"]:
        out = out.where(F.col("lang") == F.lit(q["lang"]))
    if q["no_reposts"]:
        rep = is_repost if is_repost is not None else F.col("tweet_text").startswith("RT @")
        out = out.where(~F.coalesce(rep, F.lit(False)))
    for t in q["terms"]:
        out = out.where(TX.has_word("tweet_text", t))
    if "is_repost" in out.columns:
        out = out.drop("is_repost")
    if max_results is None:
        return out
    return out.orderBy(F.col("created_at").desc_nulls_last(), F.col("tweet_id").asc()).limit(max_results)


# --- insert-if-new (SNK4, SNK5, JN2, AGG9, AGG10) ---------------------------------

def first_per_key(batch: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order`` (which says what "first" is; ties by a hash of the
    row).

    Only the key, the order and a 64-bit hash are aggregated (a hot key is pre-reduced in every map
    task); the rows of the winners are found again by key and hash, so no text is carried through
    the aggregation and the rows of a hot key spread over the tasks by their hashes.
    """
    keys = [key] if isinstance(key, str) else list(key)
    plain = [F.to_json(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in batch.schema.fields]
    rows = batch.withColumn("_h", F.xxhash64(*plain))
    first = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.col("_h").alias("_first"))).alias("_w"))
    same = F.col("_h") == F.col("_w._first")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    # equal rows share key and hash: one of them stays
    return rows.join(first, same, "left_semi").dropDuplicates(keys).select(*batch.columns)


def new_rows(batch: DataFrame, target_keys: DataFrame | None, key: str = "tweet_id",
             order: Sequence[Column] = (), n_keys: int | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not yet in the target; of a key repeated in the
    batch the first in ``order`` (JN2).  ``target_keys`` None = target missing; ``n_keys``: their
    number, if known (a large target is asked through a Bloom filter first)."""
    fresh = batch if target_keys is None else anti_join(batch, target_keys, key, n_keys)
    return first_per_key(fresh, key, order)


def ingest_tally(batch: DataFrame, target_keys: DataFrame | None,
                 key: str = "tweet_id") -> DataFrame:
    """One row ``(inserted, skipped)``: batch rows that would be written vs. dropped (AGG10)."""
    per_key = batch.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    if target_keys is None:
        flagged = per_key.withColumn("_seen", F.lit(False))
    else:
        seen = target_keys.select(key).distinct().withColumn("_seen", F.lit(True))
        flagged = per_key.join(seen, on=key, how="left").withColumn(
            "_seen", F.coalesce(F.col("_seen"), F.lit(False)))
    return flagged.agg(
        F.coalesce(F.sum(F.when(~F.col("_seen"), 1).otherwise(0)), F.lit(0)).cast("long").alias("inserted"),
        F.coalesce(F.sum(F.col("_n") - F.when(~F.col("_seen"), 1).otherwise(0)), F.lit(0)).cast("long").alias("skipped"),
    )

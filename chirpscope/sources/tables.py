"""Driver tables and the ``posts`` view built from them.

The post table of the reference is a flat record per post.  On the driver's
tables it is ``documents ⋈ events`` on id: the text comes from the document,
author/time/metrics from the event, and real columns are appended to the text
as ``#tags``, an ``@handle`` and a link so the extractors have work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; projections and filters applied later reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _post_text(d, e):
    return F.concat_ws(
        "", d["text"], F.lit(" #"), d["source"], F.lit(" #"), e["event_type"],
        F.lit(" #"), d["lang"], F.lit(" @"), d["source"], F.lit(" http://x.example/"),
        e["event_type"])


def raw_posts(spark: SparkSession, sf_dir: str, events: DataFrame | None = None,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Posts as nested API records (``public_metrics`` as a struct) — input of ingest.
    ``events``: another frame (a stream, say) in place of the events table; ``keep``: columns of
    it to pass on."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    e = (events if events is not None else read_table(spark, sf_dir, "events")).select(
        "event_id", "ts", "user_id", "event_type", "value", "props", *keep)
    j = e.join(d, d["doc_id"] == e["event_id"], "inner")
    return j.select(
        d["doc_id"].alias("id"),
        e["user_id"].alias("author_id"),
        _post_text(d, e).alias("text"),
        e["ts"].alias("created_at"),
        d["lang"].alias("lang"),
        d["source"].alias("source"),
        F.struct(
            F.floor(e["value"]).cast("int").alias("like_count"),
            F.get_json_object(e["props"], "$.k").cast("int").alias("retweet_count"),
        ).alias("public_metrics"),
        (e["event_type"] == F.lit("error")).alias("is_repost"),
        *[e[c] for c in keep],
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat ``posts`` table (schema ``schemas.POSTS``)."""
    from chirpscope.operators.ingest import flatten_records
    return flatten_records(raw_posts(spark, sf_dir))

"""Text preparation for map/reduce summarisation: newest-k, cleaning, keep-first
de-duplication, ordinal numbering, chunks of 15, prompts, a map step per chunk and
one reduce step.

Scale notes
* keep-first de-duplication aggregates fixed-width columns (a text's sha-256, its rank
  and its row number), so a text copied a million times is pre-reduced map-side; texts
  are written once and joined with the winners' row numbers;
* the whole-table ordinal is computed without a single-partition window: range
  partition + sort → per-partition offsets (a table of #partitions rows) → add;
* the default map and reduce steps are relational: every sentence of every text
  competes, ranked by keyword hits, word frequency and position; the number of
  sentences kept is the documented size of a summary;
* a caller's own summariser gets the prompt and the texts as a list.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpscope import constants as C
from chirpscope.functions import text as TX
from chirpscope.session import scratch_path

#: (prompt, texts) → summary
Summarizer = Callable[[str, list[str]], str]

#: Sentences of a chunk's summary and of the final summary (output sizes, as in the prompts).
CHUNK_SENTENCES = 4
FINAL_SENTENCES = 6
#: Characters of one partition of chunks: its words are sorted in memory.
CHARS_PER_PART = 8_000_000


def newest_k(df: DataFrame, ts_col: str = "created_at", id_col: str = "tweet_id",
             k: int = C.NEWEST_K) -> DataFrame:
    """Newest ``k`` rows, ties by id (SRC5, SRT1) — TakeOrderedAndProject."""
    return df.orderBy(F.col(ts_col).desc_nulls_last(), F.col(id_col).asc()).limit(k)


def clean_posts(df: DataFrame, text_col: str = "tweet_text", out: str = "clean_text") -> DataFrame:
    return df.withColumn(out, TX.clean_text(text_col))


def unique_texts(df: DataFrame, text_col: str = "clean_text", ts_col: str = "created_at",
                 id_col: str = "tweet_id") -> DataFrame:
    """One row per distinct text: the first in (ts desc, id asc) order wins (AGG8, WIN2).

    The order is one decimal (microseconds · 10^19 − id).  The rows are written to the shared
    folder once, numbered; the winners come from an aggregation over (sha-256, decimal, number),
    and texts are neither sorted nor aggregated, only joined with the winners' numbers."""
    micros = F.coalesce(F.unix_micros(F.col(ts_col).cast("timestamp")), F.lit(-(1 << 62))).cast("decimal(19,0)")
    rank = (micros * F.lit("10000000000000000000").cast("decimal(20,0)")).cast("decimal(38,0)") - F.coalesce(
        F.col(id_col).cast("decimal(20,0)"), F.lit("9999999999999999999").cast("decimal(20,0)"))      # a null id comes last
    path = scratch_path(df.sparkSession, "unique-texts")
    (df.where(F.col(text_col).isNotNull())
     .select(text_col, ts_col, id_col, F.sha2(F.col(text_col), 256).alias("_h"), rank.cast("decimal(38,0)").alias("_r"),
             F.monotonically_increasing_id().alias("_u"))
     .write.option("compression", "zstd").parquet(path))
    keyed = df.sparkSession.read.parquet(path)
    best = keyed.groupBy("_h").agg(F.max(F.struct("_r", "_u")).alias("_b")).select("_b._u")
    return keyed.join(best, "_u", "left_semi").select(text_col, ts_col, id_col)


def global_ordinal(df: DataFrame, order: Sequence[str | Column], name: str = "n") -> DataFrame:
    """1-based ordinal in ``order`` over a whole table, without a one-task window.

    Range-partition and sort on the order (ties must be broken by the caller's
    order keys), tag rows with ``monotonically_increasing_id`` (partition id in
    the high bits), checkpoint so both uses see the same rows, count rows per
    partition (a table with one row per partition), turn the counts into
    offsets, and broadcast those offsets back.
    """
    spark = df.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    srt = (df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
           .withColumn("_mid", F.monotonically_increasing_id()))
    srt = srt.checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), 33)
    counts = srt.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.withColumn("_off", F.sum("_c").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["_off"])
    local = F.col("_mid") - F.shiftleft(pid, 33)
    out = (srt.withColumn("_pid", pid).join(F.broadcast(offs.select("_pid", "_off")), "_pid")
           .withColumn(name, F.col("_off") + local + 1))
    return out.drop("_pid", "_off", "_mid")


def newest_first(ts_col: str = "created_at", id_col: str = "tweet_id") -> list[Column]:
    return [F.col(ts_col).desc_nulls_last(), F.col(id_col).asc()]


def chunk_of(ordinal: str = "n", chunk_size: int = C.CHUNK_SIZE) -> Column:
    return (F.floor((F.col(ordinal) - 1) / chunk_size) + 1).cast("long")


def chunk_texts(df: DataFrame, ordinal: str = "n", text_col: str = "clean_text",
                chunk_size: int = C.CHUNK_SIZE, group: Sequence[str] = ()) -> DataFrame:
    """Chunks of ``chunk_size`` consecutive texts in ordinal order (WIN1, AGG11, FN7):
    ``(chunk_id, n_texts, chunk_text, texts)``; chunk_text joins the texts by newlines."""
    g = list(group)
    return (df.groupBy(*g, chunk_of(ordinal, chunk_size).alias("chunk_id"))
            .agg(F.count(F.lit(1)).alias("n_texts"),
                 F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col(text_col).alias("t"))))
                 .alias("_items"))
            .withColumn("texts", F.transform("_items", lambda x: x["t"]))
            .select(*g, "chunk_id", "n_texts", F.array_join("texts", "\n").alias("chunk_text"), "texts"))


def chunk_prompt(chunk_text: str = "chunk_text", instruction: str = C.CHUNK_INSTRUCTION) -> Column:
    """Fixed instruction + the chunk's texts (NLP5)."""
    return F.concat(F.lit(instruction), F.col(chunk_text))


def keyword_first(df: DataFrame, text_col: str, order_col: str,
                  keywords: Iterable[str] = C.SUMMARY_KEYWORDS) -> DataFrame:
    """Flag rows mentioning any keyword (substring, case-insensitive) and number them, hits
    first, original order inside (FLT6, FLT7, SRT10, SET2)."""
    d = df.withColumn("hit", TX.contains_any(text_col, keywords))
    return global_ordinal(d, [F.col("hit").desc(), F.col(order_col).asc()], name="position")


# ---------------------------------------------------------------------------
# default map and reduce steps (NLP6, NLP7): sentences that compete
# ---------------------------------------------------------------------------

def ranked_sentences(sents: DataFrame, by: Sequence[str], position: Sequence[str],
                     keywords: Iterable[str]) -> DataFrame:
    """Adds ``hit`` and ``freq`` (1000 × mean count of the sentence's words within its group,
    rounded down) to de-duplicated sentences; ``by`` + ``position`` identify a sentence."""
    keys = [*by, *position]
    words = sents.select(*keys, F.explode(F.regexp_extract_all(F.lower("sentence"), F.lit("[a-z]+"), 0)).alias("w"))
    counts = words.groupBy(*by, "w").agg(F.count(F.lit(1)).alias("c"))
    freq = (words.join(counts, [*by, "w"]).groupBy(*keys)
            .agg(F.floor(F.lit(1000) * F.sum("c") / F.count(F.lit(1))).alias("freq")))
    return (sents.join(freq, keys, "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
            .withColumn("hit", TX.contains_any("sentence", list(keywords))))


def chunk_sentences(texts: DataFrame, ordinal: str = "n", text_col: str = "clean_text",
                    chunk_size: int = C.CHUNK_SIZE, keywords: Iterable[str] = C.SUMMARY_KEYWORDS,
                    keep: int = CHUNK_SENTENCES) -> DataFrame:
    """The ``keep`` best sentences of every chunk: ``(chunk_id, n, i, sentence)``.  Every sentence
    of every text competes; repeats (case-insensitive) count once, at their first place.

    A chunk's texts are brought together once: all groups and windows are parts of its chunk, and
    only places, not sentences, go through them."""
    split = TX.split_sentences(TX.squeeze_ws(TX.text_or_empty(text_col)))
    chars = texts.agg(F.sum(F.length(text_col))).first()[0] or 0
    base = (texts.select(chunk_of(ordinal, chunk_size).alias("chunk_id"), F.col(ordinal).cast("long").alias("n"), F.col(text_col))
            .repartition(int(chars // CHARS_PER_PART) + 1, "chunk_id"))
    once = (base.select("chunk_id", "n", F.posexplode(F.transform(split, lambda x: F.lower(x))).alias("i", "_l"))
            .groupBy("chunk_id", "_l").agg(F.min(F.struct("n", "i")).alias("s")))
    words = once.select("chunk_id", "s.n", "s.i", TX.contains_any("_l", list(keywords)).alias("hit"),
                        F.explode_outer(F.regexp_extract_all("_l", F.lit("[a-z]+"), 0)).alias("w"))
    each = words.withColumn("c", F.count("w").over(Window.partitionBy("chunk_id", "w")))
    freq = F.coalesce(F.floor(F.lit(1000) * F.sum(F.when(F.col("w").isNotNull(), F.col("c"))) / F.nullif(F.count("w"), F.lit(0))), F.lit(0))
    ranked = each.groupBy("chunk_id", "n", "i", "hit").agg(freq.alias("freq"))
    w = Window.partitionBy("chunk_id").orderBy(F.col("hit").desc(), F.col("freq").desc(), "n", "i")
    best = (ranked.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= keep)
            .groupBy("chunk_id").agg(F.collect_list(F.struct("n", "i")).alias("_best")))
    place = F.explode(F.transform(F.filter("_best", lambda x: x["n"] == F.col("n")), lambda x: x["i"]))
    return (base.join(best, "chunk_id").select("chunk_id", "n", text_col, place.alias("i"))
            .select("chunk_id", "n", "i", F.element_at(split, F.col("i") + 1).alias("sentence")))


def chunk_summaries(sentences: DataFrame) -> DataFrame:
    """One summary per chunk: its kept sentences in reading order (NLP6)."""
    return sentences.groupBy("chunk_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "i", "sentence"))), lambda x: x["sentence"]), " ").alias("summary"))


def final_summary(sentences: DataFrame, keywords: Iterable[str] = C.SUMMARY_KEYWORDS,
                  keep: int = FINAL_SENTENCES) -> DataFrame:
    """One summary of all chunks (NLP7, FN5, FN6, SET5): the chunks' sentences, chunks with a
    keyword first, repeats once; the ``keep`` best by the same score, in order, cleaned up."""
    kw = list(keywords)
    key = chunk_summaries(sentences).select("chunk_id", F.when(TX.contains_any("summary", kw), 0).otherwise(1).alias("key"))
    every = sentences.join(key, "chunk_id")
    once = (every.groupBy(F.lower("sentence").alias("_l")).agg(F.min(F.struct("key", "chunk_id", "n", "i", "sentence")).alias("s"))
            .select("s.*"))
    order = ["key", "chunk_id", "n", "i"]
    best = (ranked_sentences(once, [], order, kw)
            .orderBy(F.col("hit").desc(), F.col("freq").desc(), *order).limit(keep))
    text = best.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "sentence"))),
                                             lambda x: x["sentence"]), " ").alias("t"))
    return text.select(TX.clean_summary("t").alias("summary"))


# ---------------------------------------------------------------------------
# map and reduce steps with a caller-supplied summariser
# ---------------------------------------------------------------------------

def summarize_chunks(chunks: DataFrame, fn: Summarizer, id_col: str = "chunk_id", texts_col: str = "texts",
                     prompt: Column | None = None) -> DataFrame:
    """Map step: one summary per chunk via ``mapInPandas``; ``fn`` gets the prompt and the list
    of texts.  A failing chunk yields ``[Error summarizing chunk i: …]`` and the job goes on."""
    schema = T.StructType([chunks.schema[id_col], T.StructField("summary", T.StringType(), True)])
    text = prompt if prompt is not None else F.concat(F.lit(C.CHUNK_INSTRUCTION), F.array_join(texts_col, "\n"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            res = []
            for cid, ask, texts in zip(pdf[id_col].tolist(), pdf["_prompt"].tolist(), pdf[texts_col].tolist()):
                try:
                    res.append(fn(ask, list(texts)).strip())
                except Exception as e:  # noqa: BLE001 — reported in the row
                    res.append(f"[Error summarizing chunk {cid}: {e}]")
            yield pd.DataFrame({id_col: pdf[id_col].values, "summary": res})

    return chunks.select(id_col, text.alias("_prompt"), texts_col).mapInPandas(run, schema)


def reduce_summaries(summaries: DataFrame, fn: Summarizer, order: str = "chunk_id",
                     keywords: Iterable[str] = C.SUMMARY_KEYWORDS, fanout: int = C.CHUNK_SIZE) -> DataFrame:
    """Reduce step for a caller's summariser: summaries with a keyword first, then levels of
    groups of ``fanout`` summaries (each a list, with the final prompt around it) until one is
    left; the clean-up at the end.  What a level keeps is ``fn``'s choice alone."""
    ranked = keyword_first(summaries, "summary", order, keywords)
    cur = ranked.select(F.col("position").alias("n"), F.col("summary").alias("t"))
    while True:
        group = chunk_texts(cur, "n", "t", fanout)
        ask = F.concat(F.lit(C.FINAL_INSTRUCTION), F.array_join("texts", "\n"), F.lit(C.FINAL_SUFFIX))
        cur = summarize_chunks(group, fn, prompt=ask).select(F.col("chunk_id").alias("n"), F.col("summary").alias("t"))
        cur = cur.checkpoint(eager=True)
        if cur.limit(2).count() <= 1:
            return cur.select(TX.clean_summary("t").alias("summary"))

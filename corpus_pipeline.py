"""From raw documents to training ids: quality classifier, near-duplicates, benchmark
decontamination, mixing of sources, token files.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but
the last return the columns of ``documents``.  ``run`` writes each stage to the shared scratch
folder as Parquet and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chirpscope.llm import common as U
from chirpscope.llm import decontaminate, minhash_dedup, mixing, quality, token_output


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, U.read(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return minhash_dedup.near_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item."""
    return decontaminate.clean(docs, U.read(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the target weights of their sources ask."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_output.token_output(docs, token_output.byte_bpe())


STAGES = [("quality", keep_good), ("near_dedup", drop_near_copies), ("decontaminate", drop_contaminated),
          ("mix", mix_sources), ("tokens", write_tokens)]

#: The classifier is fitted, the mix is drawn: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = U.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = U.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

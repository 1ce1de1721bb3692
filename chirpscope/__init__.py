"""chirpscope — Spark-native analytics for short social posts.

Every operator is a function over Spark DataFrames or Columns:

* ``functions``  — column expressions (mention/tag extraction, text cleaning, CASEs)
* ``operators``  — DataFrame → DataFrame operators (graphs, sentiment, summaries, reports, ingest)
* ``sources``    — readers and writers (CSV, parquet tables, insert-if-new)
* ``streaming``  — Structured Streaming forms of the incremental steps
* ``plans``      — the query catalogue used by ``__spark_entry__`` and the bench
"""

from chirpscope.session import get_spark, checkpoint_dir, scratch_path

__all__ = ["get_spark", "checkpoint_dir", "scratch_path"]

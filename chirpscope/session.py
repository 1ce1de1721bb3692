"""Session helpers: one place for the configs every operator relies on.

* UTC session time zone (timestamps without zone must not shift).
* AQE on, with skew-join splitting and partition coalescing.
* A *shared* checkpoint folder: read from ``spark.checkpoint.dir``; only a
  local-mode session (tests, bench) may fall back to a fresh temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "chirpscope") -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or f"local[{cpus}]")
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


#: Most bytes (compressed) that AQE puts into one partition when it joins small ones: aggregations of
#: short rows hold some twenty times as much.
ADVISORY_BYTES = 16 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Session-level SQL settings that the operators depend on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > ADVISORY_BYTES:
        spark.conf.set(name, str(ADVISORY_BYTES))
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (the cluster names it).  Only when it
    is unset *and* the master is local is a private temp folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared folder "
            "for checkpoints and intermediate tables")
    path = tempfile.mkdtemp(prefix="chirpscope-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"

"""Readers: post CSVs, node-metric CSVs, table scans, key scans, ad-hoc SQL.

Schemas are always given; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpscope import schemas as S
from chirpscope.sources.csv_split import read_csv

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               "encoding": "UTF-8", "mode": "FAILFAST",
               # microseconds kept (the default format stops at milliseconds)
               "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


#: Forms of a timestamp in post files: ISO with ``T``, or a space; up to nine decimals; with or
#: without an offset (FN14).
TIMESTAMP_FORMS = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,9})?( ?(Z|[+-]\d{2}(:?\d{2})?))?$"


def parse_timestamp(c: Column) -> Column:
    """A timestamp text in any of the accepted forms as UTC without zone; blank is null, anything
    else raises."""
    t = F.trim(c)
    bad = F.raise_error(F.concat(F.lit("not a timestamp: "), t)).cast("timestamp_ntz")
    # an offset is moved to UTC; the session's zone is UTC, so a text without one is UTC too
    parsed = F.regexp_replace(t, r" (?=Z|[+-]\d)", "").try_cast("timestamp").cast("timestamp_ntz")
    return (F.when(t.isNull() | (t == ""), F.lit(None).cast("timestamp_ntz"))
            .when(t.rlike(TIMESTAMP_FORMS) & parsed.isNotNull(), parsed).otherwise(bad))


def read_posts_csv(spark: SparkSession, path: str, schema: T.StructType = S.POSTS) -> DataFrame:
    """Posts CSV with quoted fields that hold newlines (SRC1), each file read by as many tasks as
    it has blocks (``csv_split``).  Timestamps may be in any of ``TIMESTAMP_FORMS``; all else,
    a quoted field that never closes too, fails fast."""
    stamps = [f.name for f in schema.fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))]
    as_text = T.StructType([T.StructField(f.name, T.StringType(), True) if f.name in stamps else f for f in schema.fields])
    rows = read_csv(spark, path, as_text, CSV_OPTIONS)
    return rows.select(*[parse_timestamp(F.col(f.name)).cast(f.dataType).alias(f.name) if f.name in stamps else F.col(f.name)
                         for f in schema.fields])


def read_node_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """Saved node-metric table (SRC2)."""
    return spark.read.schema(S.NODE_METRICS).options(**CSV_OPTIONS).csv(path)


def scan_not_null(df: DataFrame, cols: list[str], not_null: str) -> DataFrame:
    """Projection plus a not-null predicate; both reach the parquet scan (SRC3, FLT1)."""
    return df.select(*cols).where(F.col(not_null).isNotNull())


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    if "/" not in name_or_path:
        return spark.catalog.tableExists(name_or_path)
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(name_or_path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def key_scan(spark: SparkSession, name_or_path: str, key: str = "tweet_id",
             key_type: T.DataType = T.LongType()) -> DataFrame:
    """Keys of a target; a *missing* target gives an empty key set (SRC4).  Any other
    error is raised, not mistaken for "missing"."""
    if not table_exists(spark, name_or_path):
        return spark.createDataFrame([], T.StructType([T.StructField(key, key_type, True)]))
    df = spark.table(name_or_path) if "/" not in name_or_path else spark.read.parquet(name_or_path)
    return df.select(key)


def run_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Ad-hoc SQL over registered views, or over frames named ``{name}`` in the text (SRC6,
    SRC7); no view of the user's is touched.  Errors propagate."""
    return spark.sql(query, **tables)

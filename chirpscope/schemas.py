"""Named StructTypes: every table the library reads or writes has one (never infer)."""

from pyspark.sql import types as T

POSTS = T.StructType([
    T.StructField("tweet_id", T.LongType(), False),
    T.StructField("author_id", T.LongType(), True),
    T.StructField("tweet_text", T.StringType(), False),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("lang", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("like_count", T.IntegerType(), True),
    T.StructField("retweet_count", T.IntegerType(), True),
    T.StructField("sentiment", T.StringType(), True),
])

# nested source record as it lands from a post API (metrics as a record)
RAW_POST = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("author_id", T.LongType(), True),
    T.StructField("text", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("lang", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("public_metrics", T.StructType([
        T.StructField("like_count", T.IntegerType(), True),
        T.StructField("retweet_count", T.IntegerType(), True),
    ]), True),
])

POSTS_SCORED_LEXICON = T.StructType(
    POSTS.fields + [T.StructField("polarity", T.DoubleType(), True)])

POSTS_SCORED_MODEL = T.StructType(
    [f for f in POSTS.fields if f.name != "sentiment"]
    + [T.StructField("label", T.StringType(), True),
       T.StructField("score", T.DoubleType(), True)])

DIRECTED_EDGES = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("target", T.StringType(), False),
    T.StructField("weight", T.LongType(), False),
])

UNDIRECTED_EDGES = T.StructType([
    T.StructField("node_u", T.StringType(), False),
    T.StructField("node_v", T.StringType(), False),
    T.StructField("weight", T.LongType(), False),
])

NODE_METRICS = T.StructType([
    T.StructField("node", T.StringType(), False),
    T.StructField("degree", T.LongType(), False),
    T.StructField("betweenness", T.DoubleType(), False),
    T.StructField("pagerank", T.DoubleType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("node_type", T.StringType(), False),
])

SUMMARIES = T.StructType([
    T.StructField("summary", T.StringType(), True),
    T.StructField("generated_at", T.TimestampType(), True),
])

LEXICON = T.StructType([
    T.StructField("token", T.StringType(), False),
    T.StructField("score", T.DoubleType(), False),
])

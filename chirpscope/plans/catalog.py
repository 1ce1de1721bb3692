"""The query catalogue: every operator family as a (spark, sf_dir) → DataFrame job.

Each query reads the driver's tables (or what Spark derives from them) in full.
``ORACLE`` holds the DuckDB twin of each query where one exists; column names
and rounding are the same on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpscope import constants as C
from chirpscope import schemas as S
from chirpscope.functions import text as TX
from chirpscope.operators import graph as G
from chirpscope.plans import oracle_sql as O
from chirpscope.session import scratch_path
from chirpscope.sources.tables import posts, raw_posts, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

PR_DIGITS = 9      # rounding of PageRank / betweenness in outputs


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _posts(spark, sf):
    return posts(spark, sf)


# ---------------------------------------------------------------------------
# graph: edges, degree, PageRank, betweenness, metrics, top-k
# ---------------------------------------------------------------------------

@query("mentions", O.with_posts(
    f"SELECT tweet_id, unnest({O.mentions_sql('tweet_text')}) AS mention FROM posts"))
def q_mentions(spark, sf):
    return G.mentions(_posts(spark, sf)).select("tweet_id", "mention")


@query("hashtags", O.with_posts(
    f"SELECT tweet_id, unnest({O.tags_sql('tweet_text')}) AS hashtag FROM posts"))
def q_hashtags(spark, sf):
    return G.hashtags(_posts(spark, sf))


@query("mention_edges", O.with_posts("SELECT * FROM m_edges", O.MENTION_EDGES_CTE))
def q_mention_edges(spark, sf):
    return G.mention_edges(_posts(spark, sf))


@query("hashtag_edges", O.with_posts("SELECT * FROM h_edges", O.HASHTAG_EDGES_CTE))
def q_hashtag_edges(spark, sf):
    return G.hashtag_edges(_posts(spark, sf))


@query("basket_edges", """
WITH li AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL)
SELECT a.l_suppkey AS node_u, b.l_suppkey AS node_v, count(*) AS weight
FROM li a JOIN li b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey
GROUP BY 1, 2""")
def q_basket_edges(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    return G.basket_edges(li, "l_orderkey", "l_suppkey")


_BASKET_SQL = """b_edges AS (SELECT a.l_suppkey AS node_u, b.l_suppkey AS node_v, count(*) AS weight
  FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL) a
  JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL) b
    ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY 1, 2)"""


@query("basket_pagerank", "WITH " + _BASKET_SQL + ", " + O.pagerank_ctes("b_edges", "node_u", "node_v", False, "bp", rounds=30)
       + f" SELECT node, round(pagerank, {PR_DIGITS}) AS pagerank FROM bp_pr")
def q_basket_pagerank(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    e = G.basket_edges(li, "l_orderkey", "l_suppkey")
    return G.pagerank(e, directed=False).select("node", F.round("pagerank", PR_DIGITS).alias("pagerank"))


@query("mention_degree", O.with_posts("SELECT * FROM md_deg",
                                      O.MENTION_EDGES_CTE + "," + O.degree_cte("m_edges", "source", "target", "md")))
def q_mention_degree(spark, sf):
    return G.degree(G.mention_edges(_posts(spark, sf)), directed=True)


@query("hashtag_degree", O.with_posts("SELECT * FROM hd_deg",
                                      O.HASHTAG_EDGES_CTE + "," + O.degree_cte("h_edges", "node_u", "node_v", "hd")))
def q_hashtag_degree(spark, sf):
    return G.degree(G.hashtag_edges(_posts(spark, sf)), directed=False)


@query("mention_pagerank", O.with_posts(
    f"SELECT node, round(pagerank, {PR_DIGITS}) AS pagerank FROM mp_pr",
    O.MENTION_EDGES_CTE + "," + O.pagerank_ctes("m_edges", "source", "target", True, "mp")))
def q_mention_pagerank(spark, sf):
    e = G.mention_edges(_posts(spark, sf))
    return G.pagerank(e, directed=True).select("node", F.round("pagerank", PR_DIGITS).alias("pagerank"))


@query("hashtag_pagerank", O.with_posts(
    f"SELECT node, round(pagerank, {PR_DIGITS}) AS pagerank FROM hp_pr",
    O.HASHTAG_EDGES_CTE + "," + O.pagerank_ctes("h_edges", "node_u", "node_v", False, "hp")))
def q_hashtag_pagerank(spark, sf):
    e = G.hashtag_edges(_posts(spark, sf))
    return G.pagerank(e, directed=False).select("node", F.round("pagerank", PR_DIGITS).alias("pagerank"))


@query("hashtag_betweenness", O.with_posts(
    f"SELECT node, round(betweenness, {PR_DIGITS}) AS betweenness FROM hb_bt",
    O.HASHTAG_EDGES_CTE + "," + O.betweenness_ctes("h_edges", "node_u", "node_v", False, "hb")))
def q_hashtag_betweenness(spark, sf):
    e = G.hashtag_edges(_posts(spark, sf))
    return G.betweenness(e, directed=False).select(
        "node", F.round("betweenness", PR_DIGITS).alias("betweenness"))


@query("basket_betweenness", "WITH " + _BASKET_SQL + ", " + O.betweenness_ctes("b_edges", "node_u", "node_v", False, "bb")
       + f" SELECT node, round(betweenness, {PR_DIGITS}) AS betweenness FROM bb_bt")
def q_basket_betweenness(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    return G.betweenness(G.basket_edges(li, "l_orderkey", "l_suppkey"), directed=False).select(
        "node", F.round("betweenness", PR_DIGITS).alias("betweenness"))


def _metrics(spark, sf, mention: bool = True, hashtag: bool = True, p: DataFrame | None = None) -> DataFrame:
    """Node-metric table; node types are disjoint by prefix ('@'/'user:' only in the
    mention graph, '#' only in the tag graph), so a top-k over one type family
    needs only that graph's metrics."""
    if p is None:
        p = G.marks(_posts(spark, sf)).checkpoint(eager=True)
    parts = []
    if mention:
        me = G.mention_edges(p).checkpoint(eager=True)
        parts.append(G.centrality_table(me, True, C.GRAPH_KIND_MENTION).withColumn("node_type", TX.node_type("node")))
    if hashtag:
        he = G.hashtag_edges(p).checkpoint(eager=True)
        parts.append(G.centrality_table(he, False, C.GRAPH_KIND_HASHTAG).withColumn("node_type", TX.node_type("node")))
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out


@query("node_metrics", O.with_posts(
    f"SELECT node, degree, round(betweenness, {PR_DIGITS}) AS betweenness, "
    f"round(pagerank, {PR_DIGITS}) AS pagerank, type, node_type FROM nmt", O.metrics_ctes()))
def q_node_metrics(spark, sf):
    return _metrics(spark, sf).select(
        "node", "degree", F.round("betweenness", PR_DIGITS).alias("betweenness"),
        F.round("pagerank", PR_DIGITS).alias("pagerank"), "type", "node_type")


_TOP_SQL = ("SELECT node, degree, round(pagerank, {d}) AS pagerank, round(betweenness, {d}) AS betweenness{extra} "
            "FROM nmt WHERE node_type IN ({types}) ORDER BY round(pagerank, 12) DESC, degree DESC, fs LIMIT {k}")


@query("top_accounts", O.with_posts(
    _TOP_SQL.format(d=PR_DIGITS, extra=", node_type", types="'user', 'user_id'", k=C.TOP_K), O.metrics_ctes()))
def q_top_accounts(spark, sf):
    t = G.top_nodes(_metrics(spark, sf, hashtag=False), [C.NODE_TYPE_USER, C.NODE_TYPE_USER_ID], with_type=True)
    return t.select("node", "degree", F.round("pagerank", PR_DIGITS).alias("pagerank"),
                    F.round("betweenness", PR_DIGITS).alias("betweenness"), "node_type")


@query("top_hashtags", O.with_posts(
    _TOP_SQL.format(d=PR_DIGITS, extra="", types="'hashtag'", k=C.TOP_K), O.metrics_ctes()))
def q_top_hashtags(spark, sf):
    t = G.top_nodes(_metrics(spark, sf, mention=False), [C.NODE_TYPE_HASHTAG], with_type=False)
    return t.select("node", "degree", F.round("pagerank", PR_DIGITS).alias("pagerank"),
                    F.round("betweenness", PR_DIGITS).alias("betweenness"))


@query("viz_nodes", O.with_posts(f"""
SELECT node AS id, node AS label, '{C.MENTION_NODE_COLOR}' AS color
FROM (SELECT source AS node FROM m_edges UNION SELECT target FROM m_edges)
UNION ALL
SELECT node, node, '{C.HASHTAG_NODE_COLOR}'
FROM (SELECT node_u AS node FROM h_edges UNION SELECT node_v FROM h_edges)
WHERE node NOT IN (SELECT source FROM m_edges UNION SELECT target FROM m_edges)""",
    O.MENTION_EDGES_CTE + "," + O.HASHTAG_EDGES_CTE))
def q_viz_nodes(spark, sf):
    p = _posts(spark, sf)
    return G.viz_tables(G.mention_edges(p), G.hashtag_edges(p))[0]


@query("viz_nodes_shared", O.with_posts(f"""
SELECT node AS id, node AS label, '{C.MENTION_NODE_COLOR}' AS color
FROM (SELECT source AS node FROM m_edges UNION SELECT target FROM m_edges)
UNION ALL
SELECT node, node, '{C.HASHTAG_NODE_COLOR}'
FROM (SELECT replace(node_u, '#', '@') AS node FROM h_edges UNION SELECT replace(node_v, '#', '@') FROM h_edges)
WHERE node NOT IN (SELECT source FROM m_edges UNION SELECT target FROM m_edges)""",
    O.MENTION_EDGES_CTE + "," + O.HASHTAG_EDGES_CTE))
def q_viz_nodes_shared(spark, sf):
    """Two layers that share nodes: the tags as handles, some of which the mention graph holds (JN5)."""
    p = _posts(spark, sf)
    he = G.hashtag_edges(p)
    for end in ("node_u", "node_v"):
        he = he.withColumn(end, F.replace(F.col(end), F.lit("#"), F.lit("@")))
    return G.viz_tables(G.mention_edges(p), he)[0]


@query("viz_edges", O.with_posts(f"""
SELECT source AS "from", target AS "to", weight AS value, '{C.MENTION_EDGE_COLOR}' AS color FROM m_edges
UNION ALL
SELECT node_u, node_v, weight, '{C.HASHTAG_EDGE_COLOR}' FROM h_edges""",
    O.MENTION_EDGES_CTE + "," + O.HASHTAG_EDGES_CTE))
def q_viz_edges(spark, sf):
    p = _posts(spark, sf)
    return G.viz_tables(G.mention_edges(p), G.hashtag_edges(p))[1]


@query("two_hop_neighbours", O.with_posts("""
SELECT node, min(hop) AS hop FROM (
  SELECT '#click' AS node, 0 AS hop
  UNION ALL SELECT b, 1 FROM und WHERE a = '#click'
  UNION ALL SELECT u2.b, 2 FROM und u1 JOIN und u2 ON u2.a = u1.b WHERE u1.a = '#click')
GROUP BY node""", O.HASHTAG_EDGES_CTE + """,
und AS (SELECT node_u AS a, node_v AS b FROM h_edges UNION SELECT node_v, node_u FROM h_edges)"""))
def q_two_hop(spark, sf):
    e = G.hashtag_edges(_posts(spark, sf))
    return G.neighbourhood(e, False, "#click", hops=2)


@query("nodes_by_property", O.with_posts("""
SELECT node_u AS node FROM h_edges WHERE weight IN (1, 2, 3)
UNION SELECT node_v FROM h_edges WHERE weight IN (1, 2, 3)""", O.HASHTAG_EDGES_CTE))
def q_nodes_by_property(spark, sf):
    e = G.hashtag_edges(_posts(spark, sf))
    return G.nodes_by_property(e, False, "weight", [1, 2, 3])


@query("nodes_by_value", O.with_posts(f"""
SELECT node FROM (SELECT node_u AS node FROM h_edges UNION SELECT node_v FROM h_edges)
WHERE node IN ('#click', '#en', '#src1', '#absent')""", O.HASHTAG_EDGES_CTE))
def q_nodes_by_value(spark, sf):
    p = _posts(spark, sf)
    nodes = G.viz_tables(G.mention_edges(p), G.hashtag_edges(p))[0]
    return G.nodes_by_value(nodes, "label", ["#click", "#en", "#src1", "#absent"])


@query("edge_weight_cast", O.with_posts(
    "SELECT source, target, cast(weight AS BIGINT) AS weight FROM m_edges WHERE source IS NOT NULL "
    "ORDER BY weight DESC, source, target", O.MENTION_EDGES_CTE))
def q_edge_weight_cast(spark, sf):
    e = G.mention_edges(_posts(spark, sf))
    return (e.where(F.col("source").isNotNull())
            .select("source", "target", F.col("weight").cast("long").alias("weight"))
            .orderBy(F.col("weight").desc(), "source", "target"))


# ---------------------------------------------------------------------------
# ingest: flatten, search, insert-if-new, tallies
# ---------------------------------------------------------------------------

from chirpscope.operators import ingest as I          # noqa: E402
from chirpscope.operators import report as R          # noqa: E402
from chirpscope.operators import sentiment as SN      # noqa: E402
from chirpscope.operators import summarize as SM      # noqa: E402

POST_COLS = ["tweet_id", "author_id", "tweet_text", "created_at", "lang", "source",
             "like_count", "retweet_count", "sentiment"]
_POST_COLS_SQL = ", ".join(POST_COLS)


@query("ingest_flatten", O.with_posts(f"SELECT {_POST_COLS_SQL} FROM posts"))
def q_ingest_flatten(spark, sf):
    return I.flatten_records(raw_posts(spark, sf))


SEARCH = "the and lang:en -is:retweet"
_WORD = r"[^\p{{L}}\p{{N}}_]"


def _word_sql(w: str) -> str:
    return (f"regexp_matches(lower(tweet_text), '(^|[^\\p{{L}}\\p{{N}}_]){w}([^\\p{{L}}\\p{{N}}_]|$)')"
            .replace("{{", "{").replace("}}", "}"))


@query("search_posts", O.with_posts(
    f"SELECT {_POST_COLS_SQL} FROM posts WHERE lang = 'en' AND NOT is_repost AND "
    + " AND ".join(_word_sql(w) for w in ("the", "and"))))
def q_search_posts(spark, sf):
    p = I.flatten_records(raw_posts(spark, sf), keep=["is_repost"])
    return I.search_posts(p, SEARCH, is_repost=F.col("is_repost"))


def _batch_and_target(spark, sf):
    """Batch = every post with its place 0, plus a changed copy (place 1) of the labelled ones and
    of every tenth; target = the labelled posts (keys already present)."""
    p = _posts(spark, sf)
    lab = read_table(spark, sf, "labels").select(F.col("doc_id").alias("tweet_id")).distinct()
    again = p.join(lab, "tweet_id", "left_semi").unionByName(p.where(F.col("tweet_id") % 10 == 0))
    changed = again.withColumn("tweet_text", F.concat(F.lit("changed "), F.col("tweet_text")))
    return p.withColumn("place", F.lit(0)).unionByName(changed.withColumn("place", F.lit(1))), lab


_BATCH_SQL = """batch AS (SELECT *, 0 AS place FROM posts UNION ALL
  SELECT * REPLACE ('changed ' || tweet_text AS tweet_text), 1 FROM posts WHERE tweet_id IN (SELECT doc_id FROM labels)
  UNION ALL SELECT * REPLACE ('changed ' || tweet_text AS tweet_text), 1 FROM posts WHERE tweet_id % 10 = 0)"""


@query("insert_if_new", O.with_posts(
    f"SELECT {_POST_COLS_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY place) AS rn FROM batch "
    "WHERE tweet_id NOT IN (SELECT doc_id FROM labels)) WHERE rn = 1",
    _BATCH_SQL))
def q_insert_if_new(spark, sf):
    batch, lab = _batch_and_target(spark, sf)
    return I.new_rows(batch, lab, "tweet_id", [F.col("place")]).drop("place")


@query("ingest_tally", O.with_posts(
    """SELECT cast(ins AS BIGINT) AS inserted, cast(tot - ins AS BIGINT) AS skipped FROM (
  SELECT count(DISTINCT tweet_id) FILTER (WHERE tweet_id NOT IN (SELECT doc_id FROM labels)) AS ins,
         count(*) AS tot FROM batch)""", _BATCH_SQL))
def q_ingest_tally(spark, sf):
    batch, lab = _batch_and_target(spark, sf)
    return I.ingest_tally(batch, lab, "tweet_id")


@query("unscored_posts", O.with_posts(
    f"SELECT {_POST_COLS_SQL} FROM posts p WHERE NOT EXISTS "
    "(SELECT 1 FROM labels l WHERE l.doc_id = p.tweet_id)"))
def q_unscored_posts(spark, sf):
    lab = read_table(spark, sf, "labels").select(F.col("doc_id").alias("tweet_id"))
    return _posts(spark, sf).join(lab, "tweet_id", "left_anti")


@query("unscored_posts_bloom", O.with_posts(
    f"SELECT {_POST_COLS_SQL} FROM posts p WHERE NOT EXISTS "
    "(SELECT 1 FROM labels l WHERE l.doc_id = p.tweet_id)"))
def q_unscored_posts_bloom(spark, sf):
    """The same behind a Bloom filter of the target's keys (JN1)."""
    from chirpscope.operators.bloom import anti_join
    lab = read_table(spark, sf, "labels").select(F.col("doc_id").alias("tweet_id"))
    return anti_join(_posts(spark, sf), lab, "tweet_id", min_keys=0)


def _committed(spark, rows: DataFrame, part, key: str, refresh=()):
    """A commit log filled by three commits (``part`` = 0, 1, 2); each of ``refresh`` makes a table derived
    from it, which is brought up to date after the first and the second commit: the third is
    pending when it is asked."""
    from chirpscope.sources.commit_log import CommitLog
    log = CommitLog(spark, scratch_path(spark, "commits"))
    staged = scratch_path(spark, "commit-parts")              # the rows are computed once, a commit reads its part
    rows = rows.withColumn("_part", part.cast("int"))
    rows.write.partitionBy("_part").option("compression", "zstd").parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    derived = [make(log) for make in refresh]
    for i in range(3):
        log.append_new(rows.where(F.col("_part") == i).drop("_part"), key, f"part-{i}", "catalogue", -1)
        if i < 2:
            for d in derived:
                d.refresh()
    return derived


@query("search_posts_index", ORACLE["search_posts"])
def q_search_posts_index(spark, sf):
    """The search through a word index; one commit is not indexed yet (SRC8, FN11)."""
    from chirpscope.sources.search_index import SearchIndex
    p = I.flatten_records(raw_posts(spark, sf), keep=["is_repost"])
    part = F.pmod(F.coalesce("tweet_id", F.lit(0)), F.lit(3))
    index, = _committed(spark, p, part, "tweet_id", [SearchIndex])
    return index.search(SEARCH, is_repost=F.col("is_repost"))



# ---------------------------------------------------------------------------
# sentiment
# ---------------------------------------------------------------------------

_LEX_SQL = ("lex(token, score) AS (VALUES ('the', 0.5::DOUBLE), ('und', -0.6::DOUBLE), "
            "('le', 0.2::DOUBLE), ('and', -0.1::DOUBLE), ('der', 0.3::DOUBLE), ('la', -0.4::DOUBLE), "
            "('de', 0.1::DOUBLE), ('por', 0.7::DOUBLE))")


def _polarity_ctes(src: str = "posts") -> str:
    return (_LEX_SQL + f""",
toks AS (SELECT tweet_id, unnest(regexp_extract_all(lower(coalesce(tweet_text, '')), '[a-z]+')) AS token FROM {src}),
sc AS (SELECT tweet_id, avg(score) AS pol FROM toks JOIN lex USING (token) GROUP BY tweet_id),
pol AS (SELECT p.tweet_id, round(coalesce(sc.pol, 0.0), 6) + 0.0 AS polarity FROM {src} p LEFT JOIN sc USING (tweet_id)),
scored AS (SELECT tweet_id, polarity, CASE WHEN polarity > 0.05 THEN 'positive'
  WHEN polarity < -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment FROM pol)""")


@query("polarity_scores", O.with_posts("SELECT * FROM scored", _polarity_ctes()))
def q_polarity_scores(spark, sf):
    s = SN.score_lexicon(_posts(spark, sf), SN.fixture_lexicon(spark))
    return s.select("tweet_id", "polarity", "sentiment")


@query("polarity_class_counts", O.with_posts(
    "SELECT sentiment, count(*) AS count FROM scored GROUP BY sentiment", _polarity_ctes()))
def q_polarity_class_counts(spark, sf):
    s = SN.score_lexicon(_posts(spark, sf), SN.fixture_lexicon(spark))
    return R.value_counts(s, "sentiment")


@query("incremental_scoring", O.with_posts(
    "SELECT * FROM scored",
    "todo AS (SELECT * FROM posts p WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.tweet_id)), "
    + _polarity_ctes("todo")))
def q_incremental_scoring(spark, sf):
    lab = read_table(spark, sf, "labels").select(F.col("doc_id").alias("tweet_id"))
    s = SN.incremental_scoring(_posts(spark, sf), lab, SN.fixture_lexicon(spark))
    return s.select("tweet_id", "polarity", "sentiment")


def _big_lexicon(spark, sf) -> DataFrame:
    """Several thousand tokens of the documents, scored from their own letters."""
    t = read_table(spark, sf, "documents").select(F.explode(SN.tokens("text")).alias("token")).distinct()
    code = F.length("token") * 37 + F.ascii("token")
    return t.where(code % 2 == 0).select("token", (((code % 201) - 100) / F.lit(97.0)).alias("score"))


@query("polarity_scores_join", O.with_posts("SELECT * FROM scored", """
dt AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS token FROM documents),
lc AS (SELECT token, length(token) * 37 + ascii(token) AS code FROM dt),
lex AS (SELECT token, ((code % 201) - 100) / 97.0::DOUBLE AS score FROM lc WHERE code % 2 = 0),"""
    + _polarity_ctes().split(",", _LEX_SQL.count(",") + 1)[-1]))
def q_polarity_scores_join(spark, sf):
    s = SN.score_lexicon(_posts(spark, sf), _big_lexicon(spark, sf))
    return s.select("tweet_id", "polarity", "sentiment")


_LABEL_CASE = "CASE WHEN l.quality = 1 THEN 'positive' WHEN l.toxic = 1 THEN 'negative' ELSE 'neutral' END"


def _bayes_ctes(src: str = "posts") -> str:
    """CTEs ending in bayes(tweet_id, label, score): naive Bayes over the labelled documents."""
    return f"""
fit AS (SELECT {_LABEL_CASE} AS label, regexp_extract_all(lower(coalesce(d.text, '')), '[a-z]+') AS t
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
ft AS (SELECT label, unnest(t) AS token FROM fit),
fc AS (SELECT label, token, count(*) AS n FROM ft GROUP BY 1, 2),
fl AS (SELECT label, ln(count(*) / (SELECT count(*) FROM fit)) AS prior,
              coalesce((SELECT sum(n) FROM fc WHERE fc.label = fit.label), 0) + (SELECT count(DISTINCT token) FROM fc) AS total
       FROM fit GROUP BY label),
pt AS (SELECT tweet_id, token, count(*) AS n FROM (SELECT tweet_id, unnest(regexp_extract_all(lower(tweet_text), '[a-z]+')) AS token FROM {src}) GROUP BY 1, 2),
ps AS (SELECT p.tweet_id, fl.label, fl.prior + sum(coalesce(p.n, 0) * ln((coalesce(fc.n, 0) + 1) / fl.total)) AS s
       FROM pt p CROSS JOIN fl LEFT JOIN fc ON fc.label = fl.label AND fc.token = p.token GROUP BY p.tweet_id, fl.label, fl.prior),
allp AS (SELECT q.tweet_id, fl.label, coalesce(ps.s, fl.prior) AS s FROM {src} q CROSS JOIN fl
         LEFT JOIN ps ON ps.tweet_id = q.tweet_id AND ps.label = fl.label),
pm AS (SELECT *, max(s) OVER (PARTITION BY tweet_id) AS m FROM allp),
bayes AS (SELECT tweet_id, min(label) FILTER (s = m) AS label, round(1.0 / sum(exp(s - m)), 6) AS score FROM pm GROUP BY tweet_id)"""


def _bayes(spark, sf) -> SN.NaiveBayes:
    lab = read_table(spark, sf, "labels").withColumn("label", SN.class_from_labels()).select("doc_id", "label")
    return SN.fit_naive_bayes(read_table(spark, sf, "documents").select("doc_id", "text").join(lab, "doc_id"))


@query("model_scores", O.with_posts("SELECT tweet_id, label, score FROM bayes", _bayes_ctes()))
def q_model_scores(spark, sf):
    return SN.score_naive_bayes(_posts(spark, sf), _bayes(spark, sf)).select("tweet_id", "label", "score")


@query("model_plugin", O.with_posts("""SELECT tweet_id, CASE WHEN n % 7 = 0 THEN 'ERROR' WHEN n = 512 THEN 'full' ELSE 'short' END AS label,
CASE WHEN n % 7 = 0 THEN NULL ELSE n / 512.0::DOUBLE END AS score FROM (SELECT tweet_id, length(substr(tweet_text, 1, 512)) AS n FROM posts)"""))
def q_model_plugin(spark, sf):
    """A caller's model over the first 512 characters, failing on some rows (NLP4, FN8, FN9)."""
    def load():
        def model(texts):
            if any(len(t) % 7 == 0 for t in texts):
                raise ValueError("a text that the model can't take")
            return [("full" if len(t) == 512 else "short", len(t) / 512) for t in texts]
        return model

    scored = SN.score_model(_posts(spark, sf).select("tweet_id", "tweet_text"), load, max_chars=C.MODEL_MAX_CHARS)
    return scored.select("tweet_id", "label", "score")


# ---------------------------------------------------------------------------
# reports (dashboard tabs) on events / labels
# ---------------------------------------------------------------------------

@query("date_range_filter", """
SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'
  AND event_type IN ('click', 'view')""")
def q_date_range_filter(spark, sf):
    ev = read_table(spark, sf, "events")
    return R.filter_in(R.filter_date_range(ev, "ts", "2024-01-03", "2024-01-10"), "event_type", ["click", "view"])


_LABEL_CLASS_SQL = ("CASE WHEN quality = 1 THEN 'positive' WHEN toxic = 1 THEN 'negative' "
                    "ELSE 'neutral' END")


@query("class_counts", f"SELECT {_LABEL_CLASS_SQL} AS label, count(*) AS count FROM labels GROUP BY 1")
def q_class_counts(spark, sf):
    lab = read_table(spark, sf, "labels").withColumn("label", SN.class_from_labels())
    return R.value_counts(lab, "label")


@query("class_totals", f"""
SELECT count(*) AS total, count(*) FILTER (WHERE c = 'positive') AS positive,
       count(*) FILTER (WHERE c = 'negative') AS negative
FROM (SELECT {_LABEL_CLASS_SQL} AS c FROM labels)""")
def q_class_totals(spark, sf):
    lab = read_table(spark, sf, "labels").withColumn("label", SN.class_from_labels())
    return R.class_totals(lab, "label")


@query("daily_trend", """
SELECT cast(ts AS DATE) AS date, round(avg(CASE WHEN isnan(value) THEN NULL ELSE value END), 6) AS avg_value
FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def q_daily_trend(spark, sf):
    return R.daily_mean(read_table(spark, sf, "events"), "ts", "value")


@query("daily_partials", """
SELECT cast(ts AS DATE) AS date, event_type AS class, count(*) AS n,
       round(avg(CASE WHEN isnan(value) THEN NULL ELSE value END), 6) AS avg_value,
       min(CASE WHEN isnan(value) THEN NULL ELSE value END) AS least, max(CASE WHEN isnan(value) THEN NULL ELSE value END) AS most,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM events GROUP BY 1, 2""")
def q_daily_partials(spark, sf):
    """Days and classes merged from the partials of three commits, the last computed when asked (AGG3, AGG6, AGG7)."""
    from chirpscope.sources.partials import DailyPartials
    ev = read_table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    part = F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(3))
    daily, = _committed(spark, ev, part, "event_id", [lambda log: DailyPartials(log, "ts", "event_type", "value")])
    return daily.merged()


@query("date_bounds", "SELECT cast(min(ts) AS DATE) AS min_date, cast(max(ts) AS DATE) AS max_date FROM events")
def q_date_bounds(spark, sf):
    return R.date_bounds(read_table(spark, sf, "events"), "ts")


_EV_COLS = "event_id, ts, user_id, event_type, value"


@query("top_bottom_posts", f"""
SELECT * FROM (SELECT 'top' AS side, {_EV_COLS} FROM events ORDER BY value DESC NULLS LAST, event_id LIMIT 5)
UNION ALL
SELECT * FROM (SELECT 'bottom' AS side, {_EV_COLS} FROM events ORDER BY value ASC NULLS LAST, event_id LIMIT 5)""")
def q_top_bottom(spark, sf):
    ev = read_table(spark, sf, "events")
    return R.top_bottom(ev, "value", "event_id", 5, cols=_EV_COLS.split(", "))


@query("top_per_class", """
SELECT event_type, event_id, value, printf('%s (score=%.2f)', cast(event_id AS VARCHAR), value) AS display, rk AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST, event_id) AS rk
      FROM events WHERE event_type IN ('purchase', 'error'))
WHERE rk <= 5""")
def q_top_per_class(spark, sf):
    ev = read_table(spark, sf, "events").withColumn("id_text", F.col("event_id").cast("string"))
    t = R.top_per_class(ev, "event_type", "value", "event_id", 5, classes=["purchase", "error"])
    return t.select("event_type", "event_id", "value",
                    R.display_line("id_text", "value").alias("display"), F.col("rank").cast("long").alias("rank"))


@query("latest_row", f"SELECT {_EV_COLS} FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def q_latest_row(spark, sf):
    return R.latest_row(read_table(spark, sf, "events"), "ts", "event_id", _EV_COLS.split(", "))


# ---------------------------------------------------------------------------
# summarisation: newest-k, cleaning, keep-first, chunks, keyword order
# ---------------------------------------------------------------------------

_NEWEST_SQL = f"nk AS (SELECT * FROM posts ORDER BY created_at DESC, tweet_id LIMIT {C.NEWEST_K})"


@query("newest_k", O.with_posts(
    "SELECT nk.tweet_text, bayes.label AS sentiment, nk.created_at FROM nk JOIN bayes USING (tweet_id)",
    _NEWEST_SQL + ", " + _bayes_ctes("nk")))
def q_newest_k(spark, sf):
    nk = SM.newest_k(_posts(spark, sf))
    return SN.score_naive_bayes(nk, _bayes(spark, sf)).select("tweet_text", F.col("label").alias("sentiment"), "created_at")


@query("newest_k_zones", O.with_posts(
    f"SELECT tweet_id, created_at FROM posts ORDER BY created_at DESC NULLS LAST, tweet_id LIMIT {C.NEWEST_K}"))
def q_newest_k_zones(spark, sf):
    """The newest posts through zone maps; commits come in the order of time (SRC5)."""
    from chirpscope.sources.zone_maps import ZoneMap
    p = _posts(spark, sf)
    day = F.coalesce(F.dayofmonth("created_at"), F.lit(1))
    part = F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2)
    zones, = _committed(spark, p, part, "tweet_id", [ZoneMap])
    return zones.newest().select("tweet_id", "created_at")


@query("clean_texts", O.with_posts(f"SELECT tweet_id, {O.clean_text_sql('tweet_text')} AS clean_text FROM posts"))
def q_clean_texts(spark, sf):
    return SM.clean_posts(_posts(spark, sf)).select("tweet_id", "clean_text")


@query("unique_texts", O.with_posts(f"""
SELECT clean_text, created_at, tweet_id FROM (
  SELECT *, row_number() OVER (PARTITION BY clean_text ORDER BY created_at DESC, tweet_id) AS rn
  FROM (SELECT tweet_id, created_at, {O.clean_text_sql('tweet_text')} AS clean_text FROM posts))
WHERE rn = 1"""))
def q_unique_texts(spark, sf):
    return SM.unique_texts(SM.clean_posts(_posts(spark, sf)))


_CHUNKS_SQL = f"""
ct AS (SELECT tweet_id, created_at, {O.clean_text_sql('tweet_text')} AS t,
              row_number() OVER (ORDER BY created_at DESC, tweet_id) AS pos FROM posts),
ut AS (SELECT t, min(pos) AS first_pos FROM ct GROUP BY t),
un AS (SELECT t, row_number() OVER (ORDER BY first_pos) AS n FROM ut),
chunks AS (SELECT cast(floor((n - 1) / {C.CHUNK_SIZE}) + 1 AS BIGINT) AS chunk_id, count(*) AS n_texts,
                  string_agg(t, chr(10) ORDER BY n) AS chunk_text FROM un GROUP BY 1)"""


def _numbered_texts(spark, sf) -> DataFrame:
    """Every distinct cleaned text, numbered newest first."""
    return SM.global_ordinal(SM.unique_texts(SM.clean_posts(_posts(spark, sf))), SM.newest_first())


def _chunks(spark, sf) -> DataFrame:
    return SM.chunk_texts(_numbered_texts(spark, sf))


@query("text_chunks", O.with_posts(
    "SELECT chunk_id, n_texts, " + "'" + C.CHUNK_INSTRUCTION.replace("'", "''").replace("\n", "' || chr(10) || '")
    + "' || chunk_text AS prompt FROM chunks", _CHUNKS_SQL))
def q_text_chunks(spark, sf):
    return _chunks(spark, sf).select("chunk_id", "n_texts", SM.chunk_prompt().alias("prompt"))


@query("conversation_chunks", f"""
WITH o AS (SELECT row_number() OVER (ORDER BY conv_id, turn) AS n, {O.clean_text_sql('text')} AS t FROM conversations)
SELECT cast(floor((n - 1) / {C.CHUNK_SIZE}) + 1 AS BIGINT) AS chunk_id, count(*) AS n_texts,
       string_agg(t, chr(10) ORDER BY n) AS chunk_text FROM o GROUP BY 1""")
def q_conversation_chunks(spark, sf):
    cv = read_table(spark, sf, "conversations").withColumn("clean_text", TX.clean_text("text"))
    n = SM.global_ordinal(cv.select("conv_id", "turn", "clean_text"), ["conv_id", "turn"])
    return SM.chunk_texts(n).drop("texts")


KEYWORDS = ["und", "por"]


@query("keyword_first", O.with_posts(
    "SELECT chunk_id, hit, row_number() OVER (ORDER BY hit DESC, chunk_id) AS position FROM ("
    "SELECT chunk_id, " + " OR ".join(f"contains(lower(chunk_text), '{k}')" for k in KEYWORDS)
    + " AS hit FROM chunks)", _CHUNKS_SQL))
def q_keyword_first(spark, sf):
    ordered = SM.keyword_first(_chunks(spark, sf), "chunk_text", "chunk_id", KEYWORDS)
    return ordered.select("chunk_id", "hit", F.col("position").cast("long").alias("position"))


# ---------------------------------------------------------------------------
# summary clean-up, map and reduce steps
# ---------------------------------------------------------------------------

def _split_sql(t: str) -> str:
    """Sentence list of an ASCII, squeezed text (break after . ! ? + whitespace)."""
    marked = f"regexp_replace({t}, '([.!?]){O.ASCII_WS}+', '\\1' || chr(57344), 'g')"
    return (f"list_filter(list_transform(string_split({marked}, chr(57344)), lambda s: trim(s)), "
            f"lambda s: s <> '')")


def _clean_summary_sql(col: str) -> str:
    t = f"coalesce({col}, '')"
    t = f"regexp_replace({t}, 'http{O.NON_WS}+', '', 'g')"
    t = f"regexp_replace({t}, '#{O.NON_WS}+', '', 'g')"
    t = f"regexp_replace({t}, '[^\\x{{00}}-\\x{{7F}}]+', ' ', 'g')"
    t = f"trim(regexp_replace({t}, '{O.WS}+', ' ', 'g'))"
    return t


@query("summary_cleanup", f"""
WITH a AS (SELECT doc_id, {_split_sql(_clean_summary_sql('text'))} AS s FROM documents),
b AS (SELECT doc_id, s, list_transform(s, lambda x: lower(x)) AS ls FROM a)
SELECT doc_id, trim(array_to_string(list_filter(s, lambda x, i: list_position(ls, lower(x)) = i), ' ')) AS summary
FROM b""")
def q_summary_cleanup(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", TX.clean_summary("text").alias("summary"))


_HIT_SQL = "(" + " OR ".join(f"contains(lower({{c}}), '{k}')" for k in KEYWORDS) + ")"


def _ranked_sql(src: str, out: str, by: str, pos: str) -> str:
    """CTE ``out``: the sentences of ``src`` with hit and freq (see ranked_sentences)."""
    keys = f"{by + ', ' if by else ''}{pos}"
    words = "w" if not by else f"{by}, w"
    return f"""
{out}w AS (SELECT {keys}, unnest(regexp_extract_all(lower(s), '[a-z]+')) AS w FROM {src}),
{out}c AS (SELECT {words}, count(*) AS c FROM {out}w GROUP BY ALL),
{out}f AS (SELECT {keys}, floor(1000 * sum(c) / count(*)) AS freq FROM {out}w JOIN {out}c USING ({words}) GROUP BY ALL),
{out} AS (SELECT x.*, coalesce(f.freq, 0) AS freq, {_HIT_SQL.format(c='x.s')} AS hit
          FROM {src} x LEFT JOIN {out}f f USING ({keys}))"""


_SENTENCES_SQL = _CHUNKS_SQL + f""",
sl AS (SELECT cast(floor((n - 1) / {C.CHUNK_SIZE}) + 1 AS BIGINT) AS chunk_id, n, {_split_sql('t')} AS ss FROM un),
sx AS (SELECT chunk_id, n, i, ss[i] AS s FROM (SELECT *, unnest(range(1, len(ss) + 1)) AS i FROM sl)),
sd AS (SELECT chunk_id, n, i, s FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id, lower(s) ORDER BY n, i) AS rn FROM sx) WHERE rn = 1),
""" + _ranked_sql("sd", "sr", "chunk_id", "n, i") + f""",
sk AS (SELECT chunk_id, n, i, s FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY hit DESC, freq DESC, n, i) AS k FROM sr)
       WHERE k <= {SM.CHUNK_SENTENCES}),
summ AS (SELECT chunk_id, string_agg(s, ' ' ORDER BY n, i) AS summary FROM sk GROUP BY chunk_id)"""


def _kept_sentences(spark, sf) -> DataFrame:
    return SM.chunk_sentences(_numbered_texts(spark, sf), keywords=KEYWORDS).checkpoint(eager=True)


@query("chunk_summaries", O.with_posts("SELECT chunk_id, summary FROM summ", _SENTENCES_SQL))
def q_chunk_summaries(spark, sf):
    return SM.chunk_summaries(_kept_sentences(spark, sf))


_FINAL_SQL = _SENTENCES_SQL + f""",
fk AS (SELECT sk.*, CASE WHEN {_HIT_SQL.format(c='summ.summary')} THEN 0 ELSE 1 END AS key FROM sk JOIN summ USING (chunk_id)),
fd AS (SELECT key, chunk_id, n, i, s FROM (SELECT *, row_number() OVER (PARTITION BY lower(s) ORDER BY key, chunk_id, n, i) AS rn FROM fk) WHERE rn = 1),
""" + _ranked_sql("fd", "fr", "", "key, chunk_id, n, i") + f""",
fb AS (SELECT * FROM fr ORDER BY hit DESC, freq DESC, key, chunk_id, n, i LIMIT {SM.FINAL_SENTENCES}),
ft AS (SELECT coalesce(string_agg(s, ' ' ORDER BY key, chunk_id, n, i), '') AS text FROM fb),
fs AS (SELECT {_split_sql(_clean_summary_sql('text'))} AS s FROM ft)"""


@query("final_summary", O.with_posts(
    "SELECT trim(array_to_string(list_filter(s, lambda x, i: list_position(list_transform(s, lambda y: lower(y)), lower(x)) = i), ' ')) AS summary FROM fs",
    _FINAL_SQL))
def q_final_summary(spark, sf):
    return SM.final_summary(_kept_sentences(spark, sf), KEYWORDS)


# ---------------------------------------------------------------------------
# sources and sinks: CSV round trip, SQL over views
# ---------------------------------------------------------------------------

@query("csv_roundtrip", O.with_posts(f"SELECT {_POST_COLS_SQL} FROM posts"))
def q_csv_roundtrip(spark, sf):
    from chirpscope.sources.readers import read_posts_csv
    from chirpscope.sources.writers import append_csv, write_csv
    p = _posts(spark, sf)
    path = scratch_path(spark, "posts-csv")
    labelled = p.join(read_table(spark, sf, "labels").select(F.col("doc_id").alias("tweet_id")), "tweet_id", "left_semi")
    write_csv(labelled, path)                                          # SNK1
    append_csv(p.join(labelled.select("tweet_id"), "tweet_id", "left_anti"), path)   # SNK2
    return read_posts_csv(spark, path, S.POSTS)                        # SRC1


@query("csv_offset_roundtrip", O.with_posts("SELECT tweet_id, tweet_text, created_at FROM posts"))
def q_csv_offset_roundtrip(spark, sf):
    """Post files as other tools write them: a space, no decimals or some, an offset or none."""
    from chirpscope.sources.readers import read_posts_csv
    from chirpscope.sources.writers import write_csv
    p = _posts(spark, sf)
    path = scratch_path(spark, "posts-offset-csv")
    there = F.date_format(F.col("created_at") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    form = (F.when(F.col("tweet_id") % 3 == 0, F.concat(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00")))
            .when(F.col("tweet_id") % 3 == 1, F.concat(there, F.lit("+02:00")))
            .otherwise(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))
    write_csv(p.withColumn("created_at", form), path)
    return read_posts_csv(spark, path, S.POSTS).select("tweet_id", "tweet_text", "created_at")


@query("table_scan_sql", O.with_posts(
    "SELECT tweet_id, author_id, tweet_text, created_at FROM posts WHERE tweet_text IS NOT NULL"))
def q_table_scan_sql(spark, sf):
    from chirpscope.sources.readers import run_sql, scan_not_null
    return scan_not_null(run_sql(spark, "SELECT * FROM {posts}", posts=_posts(spark, sf)),
                         ["tweet_id", "author_id", "tweet_text", "created_at"], "tweet_text").orderBy("created_at")


@query("metrics_reread", O.with_posts(
    "SELECT node, degree, round(pagerank, 4) AS pagerank, printf('%s (pagerank=%.4f)', node, pagerank) AS line FROM (" +
    "SELECT node, degree, pagerank FROM hd_deg JOIN hp_pr USING (node) ORDER BY round(pagerank, 12) DESC, degree DESC, node "
    f"LIMIT {C.TOP_K})",
    O.HASHTAG_EDGES_CTE + "," + O.degree_cte("h_edges", "node_u", "node_v", "hd") + ","
    + O.pagerank_ctes("h_edges", "node_u", "node_v", False, "hp")))
def q_metrics_reread(spark, sf):
    """Save the metrics table, read it back, top nodes with their display lines (SRC2, SRT8, FN16)."""
    from chirpscope.sources.readers import read_node_metrics_csv
    from chirpscope.sources.writers import write_csv
    path = scratch_path(spark, "metrics-csv")
    write_csv(_metrics(spark, sf, mention=False).select(*S.NODE_METRICS.names), path)
    top = G.top_nodes(read_node_metrics_csv(spark, path), [C.NODE_TYPE_HASHTAG], with_type=False)
    line = F.format_string("%s (pagerank=%.4f)", F.col("node"), F.col("pagerank"))
    return top.select("node", "degree", F.round("pagerank", 4).alias("pagerank"), line.alias("line"))


@query("network_exports", O.with_posts("""
SELECT 'mention_edges' AS file, count(*) AS rows, cast(sum(weight) AS BIGINT) AS total FROM m_edges
UNION ALL SELECT 'hashtag_edges', count(*), cast(sum(weight) AS BIGINT) FROM h_edges
UNION ALL SELECT 'nodes_metrics', count(*), cast(sum(degree) AS BIGINT) FROM (SELECT degree FROM hd_deg UNION ALL SELECT degree FROM md_deg)
UNION ALL SELECT 'top_hashtags', least(count(*), 10), NULL FROM hd_deg
UNION ALL SELECT 'top_accounts', least(count(*), 10), NULL FROM md_deg""",
    O.MENTION_EDGES_CTE + "," + O.HASHTAG_EDGES_CTE + "," + O.degree_cte("h_edges", "node_u", "node_v", "hd") + ","
    + O.degree_cte("m_edges", "source", "target", "md")))
def q_network_exports(spark, sf):
    """All five exports of both graphs written and read back (SNK3)."""
    from chirpscope.sources.writers import export_network
    p = G.marks(_posts(spark, sf)).checkpoint(eager=True)          # whole texts are read once
    me, he = G.mention_edges(p).checkpoint(eager=True), G.hashtag_edges(p).checkpoint(eager=True)
    nodes = _metrics(spark, sf, p=p).select(*S.NODE_METRICS.names).checkpoint(eager=True)
    base = scratch_path(spark, "network")
    names = ["mention_edges", "hashtag_edges", "nodes_metrics", "top_accounts", "top_hashtags"]
    paths = {n: f"{base}/{n}" for n in names}
    export_network(paths, me, he, nodes, G.top_nodes(nodes, [C.NODE_TYPE_USER, C.NODE_TYPE_USER_ID]),
                   G.top_nodes(nodes, [C.NODE_TYPE_HASHTAG], with_type=False))
    out = None
    for n, of in zip(names, ["weight", "weight", "degree", None, None]):
        back = spark.read.options(header="true", multiLine="true", escape='"').csv(paths[n])
        total = F.sum(F.col(of).cast("long")) if of else F.lit(None).cast("long")
        row = back.agg(F.count(F.lit(1)).alias("rows"), total.alias("total")).select(F.lit(n).alias("file"), "rows", "total")
        out = row if out is None else out.unionByName(row)
    return out


@query("summary_log", O.with_posts(
    "SELECT summary, true AS stamped, 2 AS copies FROM summ", _SENTENCES_SQL))
def q_summary_log(spark, sf):
    """Stamped summary rows appended twice and read back (SNK7, FN19)."""
    from chirpscope.sources.writers import append_summary
    path, summaries = scratch_path(spark, "summary-log"), SM.chunk_summaries(_kept_sentences(spark, sf))
    append_summary(spark, summaries, path)
    append_summary(spark, summaries, path)
    return (spark.read.schema(S.SUMMARIES).parquet(path).groupBy("summary")
            .agg((F.count("generated_at") == F.count(F.lit(1))).alias("stamped"), F.count(F.lit(1)).cast("int").alias("copies")))


@query("latest_text", O.with_posts(
    "SELECT trim(array_to_string(list_filter(s, lambda x, i: list_position(list_transform(s, lambda y: lower(y)), lower(x)) = i), ' ')) AS value FROM fs",
    _FINAL_SQL))
def q_latest_text(spark, sf):
    """The latest summary as text, overwritten once, read back (SNK8)."""
    from chirpscope.sources.writers import write_latest_text
    path, final = scratch_path(spark, "latest-text"), SM.final_summary(_kept_sentences(spark, sf), KEYWORDS)
    write_latest_text(spark.range(1).select(F.lit("an older text").alias("summary")), path)
    write_latest_text(final, path)
    return spark.read.text(path)


@query("created_table", "SELECT count(*) FILTER (false) AS before, count(*) AS after, false AS created_again FROM events")
def q_created_table(spark, sf):
    """Create a table if absent (SNK9), scan it empty (SRC9), fill it, find it there."""
    from chirpscope.sources.writers import append_table, create_table_if_absent
    ev, path = read_table(spark, sf, "events"), scratch_path(spark, "created")
    create_table_if_absent(spark, path, ev.schema)
    before = R.value_counts(spark.read.parquet(path), "event_type").agg(F.count(F.lit(1)).alias("before")).checkpoint(eager=True)
    append_table(ev, path)
    again = create_table_if_absent(spark, path, ev.schema)
    after = spark.read.schema(ev.schema).parquet(path).agg(F.count(F.lit(1)).alias("after"))
    return before.join(after).withColumn("created_again", F.lit(again))


@query("append_posts", O.with_posts(f"SELECT {_POST_COLS_SQL} FROM posts"))
def q_append_posts(spark, sf):
    """A table appended to in two halves, partitioned by language, read back (SNK6)."""
    from chirpscope.sources.writers import append_table
    p, path = _posts(spark, sf), scratch_path(spark, "append-posts")
    half = F.pmod(F.coalesce("tweet_id", F.lit(0)), F.lit(2))
    append_table(p.where(half == 0), path, ["lang"])
    append_table(p.where(half == 1), path, ["lang"])
    return spark.read.schema(S.POSTS).parquet(path).select(*POST_COLS)


@query("key_scan", "SELECT doc_id AS tweet_id FROM labels")
def q_key_scan(spark, sf):
    """Keys of an existing target (SRC4)."""
    from chirpscope.sources.readers import key_scan
    path = scratch_path(spark, "keyed")
    read_table(spark, sf, "labels").select(F.col("doc_id").alias("tweet_id"), "quality").write.parquet(path)
    return key_scan(spark, path)


# ---------------------------------------------------------------------------
# reports over scored posts
# ---------------------------------------------------------------------------

_REPORT_SQL = _polarity_ctes() + """,
rp AS (SELECT p.tweet_id, p.tweet_text, p.created_at, s.polarity, s.sentiment FROM posts p JOIN scored s USING (tweet_id)
       WHERE p.created_at >= TIMESTAMP '2024-01-01' AND p.created_at < TIMESTAMP '2024-02-01' AND s.sentiment IN ('positive', 'negative'))"""


def _report_posts(spark, sf) -> DataFrame:
    """Posts of a date range and of two classes, with polarity: the frame all reports start from."""
    in_range = R.filter_date_range(_posts(spark, sf), "created_at", "2024-01-01", "2024-01-31")
    return R.filter_in(SN.score_lexicon(in_range, SN.fixture_lexicon(spark)), "sentiment", ["positive", "negative"])


@query("scored_totals", O.with_posts("""SELECT count(*) AS total, count(*) FILTER (sentiment = 'positive') AS positive,
count(*) FILTER (sentiment = 'negative') AS negative FROM rp""", _REPORT_SQL))
def q_scored_totals(spark, sf):
    return R.class_totals(_report_posts(spark, sf), "sentiment")


@query("scored_counts", O.with_posts("SELECT sentiment, count(*) AS count FROM rp GROUP BY 1", _REPORT_SQL))
def q_scored_counts(spark, sf):
    return R.value_counts(_report_posts(spark, sf), "sentiment")


@query("scored_trend", O.with_posts(
    "SELECT cast(created_at AS DATE) AS date, round(avg(polarity), 6) AS avg_polarity FROM rp GROUP BY 1", _REPORT_SQL))
def q_scored_trend(spark, sf):
    return R.daily_mean(_report_posts(spark, sf), "created_at", "polarity", out="avg_polarity")


@query("scored_top_bottom", O.with_posts("""
SELECT * FROM (SELECT 'top' AS side, tweet_text, polarity FROM rp ORDER BY polarity DESC, tweet_id LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'bottom' AS side, tweet_text, polarity FROM rp ORDER BY polarity, tweet_id LIMIT 5)""", _REPORT_SQL))
def q_scored_top_bottom(spark, sf):
    return R.top_bottom(_report_posts(spark, sf), "polarity", "tweet_id", 5, cols=["tweet_text", "polarity"])


@query("scored_top_per_label", O.with_posts("""
SELECT label, tweet_id, score, printf('%s (score=%.2f)', cast(tweet_id AS VARCHAR), score) AS display, rk AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, tweet_id) AS rk FROM bayes) WHERE rk <= 5""", _bayes_ctes()))
def q_scored_top_per_label(spark, sf):
    s = SN.score_naive_bayes(_posts(spark, sf), _bayes(spark, sf)).withColumn("id_text", F.col("tweet_id").cast("string"))
    t = R.top_per_class(s, "label", "score", "tweet_id", 5)
    return t.select("label", "tweet_id", "score", R.display_line("id_text", "score").alias("display"), F.col("rank").cast("long").alias("rank"))


# ---------------------------------------------------------------------------
# streaming: the events table as several files, drained one by one (availableNow)
# ---------------------------------------------------------------------------

def _event_files(spark, sf) -> tuple[str, DataFrame]:
    """The events in four writes by id (``place`` 0), every fifth once more with another value
    (``place`` 1): some of these in the same write as the first, some in a later one."""
    ev = read_table(spark, sf, "events").withColumn("place", F.lit(0))
    late = ev.where("event_id % 5 = 0").withColumn("value", -F.col("value") - 1).withColumn("place", F.lit(1))
    f = F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(4))
    files = ev.withColumn("f", f).unionByName(late.withColumn("f", F.least(f + F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(2)), F.lit(3))))
    path = scratch_path(spark, "event-files")
    for k in range(4):                       # one after the other: files are read in order of their time
        # rows of one id share a file
        files.where(F.col("f") == k).drop("f").repartition(_files_a_batch(spark), "event_id").write.mode("append").parquet(path)
    return path, ev.limit(0)


def _files_a_batch(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _event_stream(spark, path, like):
    from chirpscope.streaming.incremental import file_stream
    return file_stream(spark, path, like.schema, max_files=_files_a_batch(spark))


def _drained(run) -> None:
    """Run a stream twice on one checkpoint: the second run must find nothing new."""
    run()
    if (again := run()):
        raise RuntimeError(f"the second run read {again} rows again")


@query("stream_ingest", O.with_posts(f"SELECT {_POST_COLS_SQL} FROM posts"))
def q_stream_ingest(spark, sf):
    """Several micro-batches into a target that already holds the labelled posts (STR1, SNK4, SNK5)."""
    from chirpscope.sources.writers import insert_if_new, read_committed
    from chirpscope.streaming.incremental import stream_ingest
    path, like = _event_files(spark, sf)
    target, checkpoint = scratch_path(spark, "stream-posts"), scratch_path(spark, "stream-posts-checkpoint")
    lab = read_table(spark, sf, "labels").select(F.col("doc_id").alias("tweet_id"))
    insert_if_new(spark, _posts(spark, sf).join(lab, "tweet_id", "left_semi"), target)
    _drained(lambda: stream_ingest(raw_posts(spark, sf, _event_stream(spark, path, like), ("place",)), target, checkpoint,
                                   order=["place"]))
    return read_committed(spark, target).select(*POST_COLS)


@query("stream_scoring", O.with_posts("SELECT * FROM scored", _polarity_ctes()))
def q_stream_scoring(spark, sf):
    from chirpscope.sources.writers import insert_if_new, read_committed
    from chirpscope.streaming.incremental import stream_scoring
    path, like = _event_files(spark, sf)
    target, checkpoint = scratch_path(spark, "stream-scored"), scratch_path(spark, "stream-scored-checkpoint")
    lab = read_table(spark, sf, "labels").select(F.col("doc_id").alias("tweet_id"))
    lex = SN.fixture_lexicon(spark)
    insert_if_new(spark, SN.score_lexicon(_posts(spark, sf).join(lab, "tweet_id", "left_semi"), lex), target)
    _drained(lambda: stream_scoring(I.flatten_records(raw_posts(spark, sf, _event_stream(spark, path, like), ("place",)), ["place"]),
                                    lex, target, checkpoint, order=["place"]))
    return read_committed(spark, target).select("tweet_id", "polarity", "sentiment")


@query("stream_closed_days", """
WITH d AS (SELECT cast(ts AS DATE) AS date, round(avg(CASE WHEN isnan(value) THEN NULL ELSE value END), 6) AS avg_value, count(*) AS n
           FROM events WHERE ts IS NOT NULL GROUP BY 1)
SELECT date, avg_value, n FROM d WHERE date + INTERVAL 3 DAY <= (SELECT max(date) + INTERVAL 1 DAY FROM d)""")
def q_stream_closed_days(spark, sf):
    """Days in order of time, each appended once it is closed (two days past its end); the days that
    may still change are open (STR3 with a watermark)."""
    from chirpscope.streaming.incremental import file_stream, stream_closed_days
    ev = read_table(spark, sf, "events")
    path, target, checkpoint = (scratch_path(spark, n) for n in ("ordered-events", "closed-days", "closed-days-checkpoint"))
    n = _files_a_batch(spark)
    ev.repartitionByRange(4 * n, "ts").sortWithinPartitions("ts").write.parquet(path)
    out = stream_closed_days(file_stream(spark, path, ev.schema, max_files=4 * n), target, checkpoint)
    if out["late"]:
        raise RuntimeError(f"{out['late']} rows of one batch were taken for late")
    return spark.read.schema("date date, avg_value double, n long, batch long").parquet(target).select("date", "avg_value", "n")


@query("stream_daily_trend", """
WITH e AS (SELECT ts, value FROM events UNION ALL SELECT ts, -value - 1 FROM events WHERE event_id % 5 = 0)
SELECT cast(ts AS DATE) AS date, round(avg(CASE WHEN isnan(value) THEN NULL ELSE value END), 6) AS avg_value
FROM e WHERE ts IS NOT NULL GROUP BY 1""")
def q_stream_daily_trend(spark, sf):
    from chirpscope.streaming.incremental import stream_daily_trend
    path, like = _event_files(spark, sf)
    target, checkpoint = scratch_path(spark, "stream-trend"), scratch_path(spark, "stream-trend-checkpoint")
    _drained(lambda: stream_daily_trend(_event_stream(spark, path, like), target, checkpoint))
    return spark.read.schema("avg_value double, date date").parquet(target).select("date", "avg_value")

"""DuckDB SQL twins of the catalogue queries (same column names, same rounding).

Iterative graph metrics are given as SQL *generated* here: one MATERIALIZED
CTE per round, a fixed number of rounds large enough for the driver's graphs.
"""

from __future__ import annotations

from chirpscope import constants as C

POSTS_SQL = """
SELECT d.doc_id AS tweet_id,
       e.user_id AS author_id,
       concat(d.text, ' #', d.source, ' #', e.event_type, ' #', d.lang, ' @', d.source,
              ' http://x.example/', e.event_type) AS tweet_text,
       e.ts AS created_at,
       d.lang AS lang,
       d.source AS source,
       coalesce(cast(floor(e.value) AS INTEGER), 0) AS like_count,
       coalesce(cast(json_extract_string(e.props, '$.k') AS INTEGER), 0) AS retweet_count,
       cast(NULL AS VARCHAR) AS sentiment,
       e.event_type = 'error' AS is_repost
FROM documents d JOIN events e ON d.doc_id = e.event_id
"""

# Python-style whitespace for RE2 (its \\s is ASCII only, without \\v)
WS = r"[\s\v\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NON_WS = r"[^\s\v\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ASCII_WS = r"[\s\v\x{1c}-\x{1f}]"

MENTION_RE, HASHTAG_RE = C.MENTION_PATTERN, C.HASHTAG_PATTERN


def with_posts(body: str, extra: str = "") -> str:
    """Prefix a query with the ``posts`` CTE (and optional further CTEs)."""
    return f"WITH posts AS ({POSTS_SQL})" + (", " + extra if extra else "") + "\n" + body


def clean_text_sql(col: str) -> str:
    t = f"coalesce({col}, '')"
    t = f"regexp_replace({t}, 'http{NON_WS}+', '', 'g')"
    t = f"regexp_replace({t}, '#{NON_WS}+', '', 'g')"
    t = f"regexp_replace({t}, '@{NON_WS}+', '', 'g')"
    t = f"regexp_replace({t}, '{WS}+', ' ', 'g')"
    return f"trim({t}, ' ')"


def tags_sql(col: str) -> str:
    return f"list_transform(regexp_extract_all(coalesce({col}, ''), '{HASHTAG_RE}', 1), lambda t: lower(t))"


def mentions_sql(col: str) -> str:
    return f"regexp_extract_all(coalesce({col}, ''), '{MENTION_RE}', 1)"


# ---------------------------------------------------------------------------
# edges
# ---------------------------------------------------------------------------

MENTION_EDGES_CTE = f"""
m_edges AS (
  SELECT 'user:' || coalesce(cast(author_id AS VARCHAR), '{C.UNKNOWN_AUTHOR}') AS source, '@' || m AS target, count(*) AS weight
  FROM (SELECT author_id, unnest({mentions_sql('tweet_text')}) AS m FROM posts)
  GROUP BY 1, 2)
"""

HASHTAG_EDGES_CTE = f"""
post_tags AS (
  SELECT DISTINCT tweet_id, unnest({tags_sql('tweet_text')}) AS tag FROM posts),
h_edges AS (
  SELECT '#' || a.tag AS node_u, '#' || b.tag AS node_v, count(*) AS weight
  FROM post_tags a JOIN post_tags b ON a.tweet_id = b.tweet_id AND a.tag < b.tag
  GROUP BY 1, 2)
"""


def pagerank_ctes(edges: str, src: str, dst: str, directed: bool, prefix: str,
                  rounds: int = 100, alpha: float = 0.85, tol: float = 1e-6) -> str:
    """CTEs ending in ``{prefix}_pr(node, pagerank)``: the first round whose L1 change
    is below N·tol (same stop rule as the Spark loop)."""
    arcs = (f"SELECT {src} AS src, {dst} AS dst, cast(weight AS DOUBLE) AS w FROM {edges}" if directed else
            f"SELECT {src} AS src, {dst} AS dst, cast(weight AS DOUBLE) AS w FROM {edges} "
            f"UNION ALL SELECT {dst}, {src}, cast(weight AS DOUBLE) FROM {edges}")
    p = prefix
    out = [f"{p}_arcs AS MATERIALIZED ({arcs})",
           f"{p}_ow AS MATERIALIZED (SELECT src, sum(w) AS ow FROM {p}_arcs GROUP BY src HAVING sum(w) > 0)",
           f"{p}_an AS MATERIALIZED (SELECT a.src, a.dst, a.w / o.ow AS wn FROM {p}_arcs a JOIN {p}_ow o USING (src))",
           f"{p}_nodes AS MATERIALIZED (SELECT node, node NOT IN (SELECT src FROM {p}_ow) AS dangling FROM "
           f"(SELECT src AS node FROM {p}_arcs UNION SELECT dst FROM {p}_arcs))",
           f"{p}_n AS MATERIALIZED (SELECT cast(count(*) AS DOUBLE) AS n FROM {p}_nodes)",
           f"{p}_r0 AS MATERIALIZED (SELECT node, cast(1 AS DOUBLE) / (SELECT n FROM {p}_n) AS x FROM {p}_nodes)"]
    for r in range(1, rounds + 1):
        prev = f"{p}_r{r-1}"
        out.append(
            f"{p}_r{r} AS MATERIALIZED (SELECT nd.node, cast({alpha} AS DOUBLE) * coalesce(m.s, 0.0) + "
            f"(cast({alpha} AS DOUBLE) * (SELECT coalesce(sum(q.x), 0.0) FROM {prev} q JOIN {p}_nodes z USING (node) WHERE z.dangling)"
            f" + cast({1.0 - alpha!r} AS DOUBLE)) / (SELECT n FROM {p}_n) AS x "
            f"FROM {p}_nodes nd LEFT JOIN (SELECT e.dst AS node, sum(q.x * e.wn) AS s FROM {p}_an e "
            f"JOIN {prev} q ON q.node = e.src GROUP BY e.dst) m ON m.node = nd.node)")
    errs = " UNION ALL ".join(
        f"SELECT {r} AS r, sum(abs(a.x - b.x)) AS err FROM {p}_r{r} a JOIN {p}_r{r-1} b USING (node)"
        for r in range(1, rounds + 1))
    out.append(f"{p}_err AS MATERIALIZED ({errs})")
    out.append(f"{p}_stop AS MATERIALIZED (SELECT coalesce(min(r), {rounds}) AS r FROM {p}_err "
               f"WHERE err < (SELECT n FROM {p}_n) * {tol})")
    alls = " UNION ALL ".join(f"SELECT {r} AS r, node, x FROM {p}_r{r}" for r in range(1, rounds + 1))
    out.append(f"{p}_pr AS (SELECT node, x AS pagerank FROM ({alls}) WHERE r = (SELECT r FROM {p}_stop))")
    return ",\n".join(out)


def betweenness_ctes(edges: str, src: str, dst: str, directed: bool, prefix: str,
                     rounds: int = 10) -> str:
    """CTEs ending in ``{prefix}_bt(node, betweenness)``: Bellman-Ford distances, path
    counts and dependencies, each unrolled ``rounds`` times."""
    p = prefix
    arcs = (f"SELECT {src} AS src, {dst} AS dst, cast(weight AS DOUBLE) AS w FROM {edges}" if directed else
            f"SELECT {src} AS src, {dst} AS dst, cast(weight AS DOUBLE) AS w FROM {edges} "
            f"UNION ALL SELECT {dst}, {src}, cast(weight AS DOUBLE) FROM {edges}")
    out = [f"{p}_a AS MATERIALIZED (SELECT src, dst, min(w) AS w FROM ({arcs}) GROUP BY src, dst)",
           f"{p}_v AS MATERIALIZED (SELECT src AS node FROM {p}_a UNION SELECT dst FROM {p}_a)",
           f"{p}_nn AS MATERIALIZED (SELECT cast(count(*) AS DOUBLE) AS n FROM {p}_v)",
           f"{p}_d0 AS MATERIALIZED (SELECT node AS s, node AS v, cast(0 AS DOUBLE) AS d FROM {p}_v)"]
    for r in range(1, rounds + 1):
        q = f"{p}_d{r-1}"
        out.append(f"{p}_d{r} AS MATERIALIZED (SELECT s, v, min(d) AS d FROM (SELECT s, v, d FROM {q} UNION ALL "
                   f"SELECT x.s, e.dst AS v, x.d + e.w AS d FROM {q} x JOIN {p}_a e ON e.src = x.v) GROUP BY s, v)")
    D = f"{p}_d{rounds}"
    out.append(f"{p}_dag AS MATERIALIZED (SELECT x.s, e.src AS u, e.dst AS v FROM {p}_a e JOIN {D} x ON x.v = e.src "
               f"JOIN {D} y ON y.s = x.s AND y.v = e.dst WHERE x.d + e.w = y.d)")
    out.append(f"{p}_x0 AS MATERIALIZED (SELECT node AS s, node AS v, cast(1 AS DOUBLE) AS x FROM {p}_v)")
    for r in range(1, rounds + 1):
        out.append(f"{p}_x{r} AS MATERIALIZED (SELECT g.s, g.v, sum(x.x) AS x FROM {p}_dag g JOIN {p}_x{r-1} x "
                   f"ON x.s = g.s AND x.v = g.u GROUP BY g.s, g.v)")
    xs = " UNION ALL ".join(f"SELECT s, v, x FROM {p}_x{r}" for r in range(0, rounds + 1))
    out.append(f"{p}_sig AS MATERIALIZED (SELECT s, v, sum(x) AS sg FROM ({xs}) GROUP BY s, v)")
    out.append(f"{p}_amat AS MATERIALIZED (SELECT g.s, g.u, g.v, a.sg / b.sg AS c FROM {p}_dag g "
               f"JOIN {p}_sig a ON a.s = g.s AND a.v = g.u JOIN {p}_sig b ON b.s = g.s AND b.v = g.v)")
    out.append(f"{p}_y0 AS MATERIALIZED (SELECT s, v, cast(1 AS DOUBLE) AS y FROM {p}_sig)")
    for r in range(1, rounds + 1):
        out.append(f"{p}_y{r} AS MATERIALIZED (SELECT a.s, a.u AS v, sum(a.c * y.y) AS y FROM {p}_amat a "
                   f"JOIN {p}_y{r-1} y ON y.s = a.s AND y.v = a.v GROUP BY a.s, a.u)")
    ys = " UNION ALL ".join(f"SELECT s, v, y FROM {p}_y{r}" for r in range(1, rounds + 1))
    out.append(f"{p}_bt AS (SELECT nd.node, CASE WHEN (SELECT n FROM {p}_nn) <= 2 THEN 0.0 ELSE "
               f"coalesce(t.b, 0.0) / (((SELECT n FROM {p}_nn) - 1) * ((SELECT n FROM {p}_nn) - 2)) END AS betweenness "
               f"FROM {p}_v nd LEFT JOIN (SELECT v, sum(y) AS b FROM ({ys}) WHERE s <> v GROUP BY v) t ON t.v = nd.node)")
    return ",\n".join(out)


def first_seen_cte(edges: str, a: str, b: str, prefix: str) -> str:
    """``{prefix}_fs(node, fs)``: rank of the first appearance (edge order by ends, then side)."""
    return (f"{prefix}_eo AS (SELECT {a} AS e1, {b} AS e2, row_number() OVER (ORDER BY {a}, {b}) AS pos FROM {edges}),\n"
            f"{prefix}_fs AS (SELECT node, min(k) AS fs FROM (SELECT e1 AS node, pos * 2 AS k FROM {prefix}_eo "
            f"UNION ALL SELECT e2 AS node, pos * 2 + 1 AS k FROM {prefix}_eo) GROUP BY node)")


def degree_cte(edges: str, a: str, b: str, prefix: str) -> str:
    return (f"{prefix}_deg AS (SELECT node, count(*) AS degree FROM (SELECT {a} AS node FROM {edges} "
            f"UNION ALL SELECT {b} FROM {edges}) GROUP BY node)")


def metrics_ctes() -> str:
    """Both graphs' metric tables as ``nm(node, degree, betweenness, pagerank, type, node_type, fs)``."""
    parts = [MENTION_EDGES_CTE.strip(), HASHTAG_EDGES_CTE.strip(),
             pagerank_ctes("m_edges", "source", "target", True, "mp"),
             pagerank_ctes("h_edges", "node_u", "node_v", False, "hp"),
             betweenness_ctes("m_edges", "source", "target", True, "mb"),
             betweenness_ctes("h_edges", "node_u", "node_v", False, "hb"),
             degree_cte("m_edges", "source", "target", "md"),
             degree_cte("h_edges", "node_u", "node_v", "hd"),
             first_seen_cte("m_edges", "source", "target", "mf"),
             first_seen_cte("h_edges", "node_u", "node_v", "hf"),
             """nm AS (
  SELECT d.node, d.degree, b.betweenness, p.pagerank, 'mention' AS type, f.fs
  FROM md_deg d JOIN mp_pr p USING (node) JOIN mb_bt b USING (node) JOIN mf_fs f USING (node)
  UNION ALL
  SELECT d.node, d.degree, b.betweenness, p.pagerank, 'hashtag' AS type, f.fs
  FROM hd_deg d JOIN hp_pr p USING (node) JOIN hb_bt b USING (node) JOIN hf_fs f USING (node)),
nmt AS (
  SELECT *, CASE WHEN node LIKE '@%' THEN 'user' WHEN node LIKE 'user:%' THEN 'user_id'
                 WHEN node LIKE '#%' THEN 'hashtag' ELSE 'other' END AS node_type FROM nm)"""]
    return ",\n".join(parts)

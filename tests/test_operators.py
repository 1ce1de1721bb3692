"""Sentiment, reports, summarisation, ingest and I/O operators on small frames."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chirpscope import schemas as S
from chirpscope.operators import ingest as I
from chirpscope.operators import report as R
from chirpscope.operators import sentiment as SN
from chirpscope.operators import summarize as SM
from chirpscope.session import scratch_path
from chirpscope.sources import readers as RD
from chirpscope.sources import writers as W


def posts_df(spark, rows):
    return spark.createDataFrame(rows, "tweet_id long, tweet_text string, created_at timestamp_ntz")


ODD_POSTS = [(1, "The and the", dt.datetime(2024, 1, 1)), (2, "nothing here", dt.datetime(2024, 1, 2)),
             (3, None, dt.datetime(2024, 1, 3)), (4, "LA la de por", dt.datetime(2024, 1, 4)), (1, "und", None),
             (None, "the", None), (None, "und und the", None), (None, None, None), (4, "LA la de por", None)]


def test_lexicon_paths_agree(spark):
    p = posts_df(spark, ODD_POSTS)
    small = SN.fixture_lexicon(spark).unionByName(spark.createDataFrame(
        [(None, 0.3), ("nothing", None), ("por", 0.1)], "token string, score double"))
    padded = small.unionByName(spark.range(100).select(
        F.concat(F.lit("zz"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("token"), F.lit(9.0).alias("score")))

    def scores(lex):
        rows = SN.lexicon_polarity(p, lex).collect()
        return sorted(((r["tweet_id"], r["tweet_text"], r["polarity"]) for r in rows), key=repr)

    got = scores(small)
    assert got == scores(padded) and len(got) == len(ODD_POSTS)
    assert (1, "The and the", 0.3) in got and (1, "und", -0.6) in got and (None, "the", 0.5) in got
    assert (None, "und und the", round((-0.6 - 0.6 + 0.5) / 3, 6)) in got and (3, None, 0.0) in got
    assert (4, "LA la de por", round((-0.4 - 0.4 + 0.1 + 0.4) / 4, 6)) in got


def test_naive_bayes(spark):
    import math
    from collections import Counter
    fit = [("positive", "good fine good"), ("positive", "fine day"), ("negative", "bad awful day"), ("neutral", None), (None, "good bad")]
    model = SN.fit_naive_bayes(spark.createDataFrame(fit, "label string, text string"))
    words = {c: Counter(w for l, t in fit if l == c for w in (t or "").split()) for c in ("negative", "neutral", "positive")}
    size = len(set().union(*words.values()))
    prior = {"negative": 1 / 4, "neutral": 1 / 4, "positive": 2 / 4}

    def want(text):
        p = {c: prior[c] * math.prod((words[c][w] + 1) / (sum(words[c].values()) + size) for w in (text or "").split()) for c in words}
        best = max(sorted(p), key=p.get)
        return best, round(p[best] / sum(p.values()), 6)

    texts = ["good day", "awful bad bad", "unseen", None, "", "good day"]
    p = posts_df(spark, [(i % 5, t, None) for i, t in enumerate(texts)] + [(None, "fine", None)])
    rows = SN.score_naive_bayes(p, model).collect()
    assert len(rows) == 7 and all((r["label"], r["score"]) == want(r["tweet_text"]) for r in rows)
    none = SN.fit_naive_bayes(spark.createDataFrame([], "label string, text string"))
    assert {r["label"] for r in SN.score_naive_bayes(p, none).collect()} == {None}


def test_words_of_chunks_are_not_shuffled(spark, monkeypatch):
    """Only whole chunks are dealt out: no word, sentence or copy of the texts goes through a shuffle of its own."""
    texts = spark.createDataFrame([(i + 1, f"One two. {'two ' * (i % 3)}three! Plain, plain {i}.") for i in range(40)], "n long, clean_text string")
    monkeypatch.setattr(SM, "CHARS_PER_PART", texts.agg(F.sum(F.length("clean_text"))).first()[0] // 2)
    plan = SM.chunk_sentences(texts)._jdf.queryExecution().executedPlan().toString()
    assert {re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)} == {"chunk_id, 3"}


def test_unique_texts_move_texts_once(spark):
    p = posts_df(spark, ODD_POSTS + [(4, "LA la de por", None), (9, "nothing here", dt.datetime(2024, 1, 2))])
    u = SM.unique_texts(p, "tweet_text")
    assert sorted((r["tweet_text"], r["tweet_id"]) for r in u.collect()) == sorted(
        {"The and the": 1, "nothing here": 2, "LA la de por": 4, "und": 1, "the": None, "und und the": None}.items())
    plan = u._jdf.queryExecution().executedPlan().toString()
    assert "first(tweet_text" not in plan and not re.search(r"hashpartitioning\(_h[^)]*_r", plan)


def test_tokens_stay_where_their_text_is(spark, monkeypatch):
    """Tokens of the broadcast part are summed up beside their text; a table cut in two gives the same."""
    def exchanged(df):
        return re.findall(r"hashpartitioning\(_key[^)]*token", df._jdf.queryExecution().executedPlan().toString())

    letters = [f"z{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    lex = spark.createDataFrame([("the", 0.5), ("la", -0.4), ("de", 0.1), ("por", 0.7), ("", 9.0), ("#1", 9.0), ("x" * 80, -1.0)]
                                + [(w, 0.25) for w in letters], "token string, score double")
    p = posts_df(spark, ODD_POSTS + [(7, "za" + " zab" * 3 + " la " + "x" * 80, None)])
    fit = spark.createDataFrame([("a", "the la la zab"), ("b", "de por de zac"), ("b", " ".join(letters))], "label string, text string")
    got = []
    for most in (SN.COMMON_TOKENS, 5):
        monkeypatch.setattr(SN, "COMMON_TOKENS", most)
        pol, bayes = SN.lexicon_polarity(p, lex), SN.score_naive_bayes(p, SN.fit_naive_bayes(fit))
        if most > 5:
            assert not exchanged(bayes) and not exchanged(SN.lexicon_polarity(p, lex.where("length(token) < 9")))
        got.append([sorted(map(str, df.collect())) for df in (pol, bayes)])
    assert got[0] == got[1]
    assert any("polarity=" + str(round((0.25 * 3 - 0.4 - 1) / 5, 6)) in r for r in got[0][0])


def test_plug_in_model_sees_whole_texts_and_reports_errors(spark):
    p = posts_df(spark, [(1, "abc", None), (2, "", None), (3, "x" * 600, None)])

    def load():
        def predict(texts):
            if "" in texts:
                raise ValueError("empty text")
            return [("neutral", float(len(t))) for t in texts]
        return predict

    got = {r["tweet_id"]: (r["label"], r["score"]) for r in SN.score_model(p, load).collect()}
    assert got == {1: ("neutral", 3.0), 2: ("ERROR", None), 3: ("neutral", 600.0)}
    assert SN.score_model(p, load, max_chars=512).where("tweet_id = 3").head()["score"] == 512.0


def test_incremental_scoring_only_new(spark):
    p = posts_df(spark, [(1, "the", None), (2, "und", None)])
    done = spark.createDataFrame([(1,)], "tweet_id long")
    got = SN.incremental_scoring(p, done, SN.fixture_lexicon(spark)).collect()
    assert [(r["tweet_id"], r["sentiment"]) for r in got] == [(2, "negative")]


def test_reports(spark):
    ev = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 23, 59), "a", 1.0), (2, dt.datetime(2024, 1, 2, 0, 0), "a", float("nan")),
         (3, dt.datetime(2024, 1, 3, 12, 0), "b", 5.0), (4, None, "b", 2.0)],
        "id long, ts timestamp_ntz, k string, v double")
    assert R.filter_date_range(ev, "ts", "2024-01-01", "2024-01-02").count() == 2
    assert R.filter_date_range(ev, "ts", None, "2024-01-02").count() == 4
    assert R.filter_in(ev, "k", []).count() == 4
    trend = {r["date"]: r["avg_value"] for r in R.daily_mean(ev, "ts", "v").collect()}
    assert trend[dt.date(2024, 1, 2)] is None and trend[dt.date(2024, 1, 1)] == 1.0
    tb = R.top_bottom(ev, "v", "id", 1, cols=["id"]).collect()
    assert [(r["side"], r["id"]) for r in tb] == [("top", 3), ("bottom", 1)]
    lr = R.latest_row(ev, "ts", "id", ["id"]).collect()
    assert lr[0]["id"] == 3
    tot = R.class_totals(spark.createDataFrame([("positive",)], "c string"), "c").collect()[0]
    assert (tot["total"], tot["positive"], tot["negative"]) == (1, 1, 0)


def test_top_per_class_plan_has_group_limit(spark):
    ev = spark.range(1000).select(F.col("id"), (F.col("id") % 3).cast("string").alias("k"),
                                  (F.col("id") * 7 % 101).cast("double").alias("v"))
    t = R.top_per_class(ev, "k", "v", "id", 5)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert t.count() == 15
    assert "WindowGroupLimit" in plan


def test_global_ordinal_matches_row_number(spark):
    df = spark.range(0, 3000).select(((F.col("id") * 7919) % 3000).alias("k"), F.col("id"))
    got = SM.global_ordinal(df, ["k", "id"], name="n")
    ref = df.withColumn("m", F.row_number().over(Window.orderBy("k", "id")))
    diff = got.join(ref, ["k", "id"]).where(F.col("n") != F.col("m")).count()
    assert diff == 0 and got.count() == 3000


def test_unique_texts_keep_first(spark):
    p = posts_df(spark, [(1, "same", dt.datetime(2024, 1, 1)), (2, "same", dt.datetime(2024, 1, 2)),
                         (3, "same", dt.datetime(2024, 1, 2)), (4, "other", dt.datetime(2024, 1, 1))])
    u = {r["tweet_text"]: r["tweet_id"] for r in SM.unique_texts(p, "tweet_text").collect()}
    assert u == {"same": 2, "other": 4}


def test_chunks(spark):
    texts = spark.createDataFrame([(i, f"Text {i}. More.") for i in range(1, 41)], "n long, clean_text string")
    ch = SM.chunk_texts(texts).orderBy("chunk_id").collect()
    assert [r["n_texts"] for r in ch] == [15, 15, 10]
    assert ch[0]["texts"][0] == "Text 1. More." and ch[0]["chunk_text"].split("\n")[1] == "Text 2. More."


def test_every_sentence_competes(spark):
    texts = spark.createDataFrame(
        [(1, "Plain start. Silver fell again. Plain end."), (2, "plain START. Rates, rates and rates."), (3, None), (4, "")], "n long, clean_text string")
    got = SM.chunk_sentences(texts, keep=2).orderBy("n", "i").collect()
    assert [r["sentence"] for r in got] == ["Silver fell again.", "Rates, rates and rates."]
    assert SM.chunk_summaries(SM.chunk_sentences(texts)).head()["summary"] == "Plain start. Silver fell again. Plain end. Rates, rates and rates."


@pytest.mark.parametrize("chunks", [16, 40, 1000])
def test_final_summary_does_not_depend_on_the_number_of_chunks(spark, chunks):
    marks = [0, chunks // 5, chunks // 4, chunks // 3, chunks // 2, chunks - 1]
    rows = [(i * 15 + 1, f"Filler number {'abcdefghij'[i % 10] * (i // 10 + 1)}. " + (f"Gold case {marks.index(i)} here." if i in marks else "")) for i in range(chunks)]
    texts = spark.createDataFrame(rows, "n long, clean_text string")
    final = SM.final_summary(SM.chunk_sentences(texts)).collect()
    assert [r["summary"] for r in final] == [" ".join(f"Gold case {k} here." for k in range(6))]


@pytest.mark.parametrize("fanout", [2, 15])
def test_plug_in_summaries_lose_nothing(spark, fanout):
    texts = spark.createDataFrame([(i, f"Line{i} a\nb." + (" gold" if i == 300 else "")) for i in range(1, 316)], "n long, clean_text string")

    def keep_all(prompt, texts):
        assert prompt.startswith("Summarize the following") and all(t in prompt for t in texts)
        return " ".join(t for t in texts)

    summaries = SM.summarize_chunks(SM.chunk_texts(texts), keep_all).checkpoint()
    assert summaries.count() == 21
    final = SM.reduce_summaries(summaries, keep_all, fanout=fanout).collect()
    assert len(final) == 1 and [f"Line{i} " in final[0]["summary"] for i in range(1, 316)] == [True] * 315
    assert final[0]["summary"].startswith("Line286 ")          # the chunk with the keyword comes first

    def boom(prompt, texts):
        raise RuntimeError("down")

    err = SM.summarize_chunks(SM.chunk_texts(texts), boom).collect()
    assert all(r["summary"].startswith(f"[Error summarizing chunk {r['chunk_id']}") for r in err)


def test_insert_if_new_and_tally(spark):
    target = scratch_path(spark, "t-posts")
    b1 = posts_df(spark, [(1, "a", None), (2, "b", None), (2, "b", None)])
    assert W.insert_if_new(spark, b1, target) == {"inserted": 2, "skipped": 1}
    b2 = posts_df(spark, [(2, "b2", None), (3, "c", None)])
    assert W.insert_if_new(spark, b2, target) == {"inserted": 1, "skipped": 1}
    got = {r["tweet_id"]: r["tweet_text"] for r in W.read_committed(spark, target).collect()}
    assert got == {1: "a", 2: "b", 3: "c"}
    tally = I.ingest_tally(b2, W.read_committed(spark, target).select("tweet_id")).collect()[0]
    assert (tally["inserted"], tally["skipped"]) == (0, 2)
    missing = RD.key_scan(spark, scratch_path(spark, "nothing"))
    assert missing.count() == 0
    b3 = spark.createDataFrame([(9, "second", None, 2), (9, "first", None, 1)], "tweet_id long, tweet_text string, created_at timestamp_ntz, seq int")
    assert W.insert_if_new(spark, b3.where("seq > 0"), scratch_path(spark, "t-first"), order=[F.col("seq")]) == {"inserted": 1, "skipped": 1}
    assert [r["tweet_text"] for r in I.new_rows(b3, None, order=[F.col("seq")]).collect()] == ["first"]


def test_streams_go_on_where_they_stopped(spark):
    from chirpscope.streaming.incremental import file_stream, stream_ingest
    src, target, checkpoint = (scratch_path(spark, x) for x in ("s-in", "s-out", "s-checkpoint"))
    rows = lambda ids, t: spark.createDataFrame([(i, None, t, None, None, None, None) for i in ids], S.RAW_POST).coalesce(1)
    rows([1, 2], "a").write.mode("append").parquet(src)
    run = lambda: stream_ingest(file_stream(spark, src, S.RAW_POST, max_files=1), target, checkpoint)
    assert (run(), run()) == (2, 0)
    rows([2, 3], "b").write.mode("append").parquet(src)
    assert run() == 2
    assert {r["tweet_id"]: r["tweet_text"] for r in W.read_committed(spark, target).collect()} == {1: "a", 2: "a", 3: "b"}


def test_timestamp_forms(spark):
    forms = {"2025-10-15 19:08:51+00:00": (19, 8, 51, 0), "2025-10-15T19:08:51.5": (19, 8, 51, 500000), "2025-10-15 19:08:51 +0200": (17, 8, 51, 0),
             "2025-10-15T19:08:51.123456Z": (19, 8, 51, 123456), " ": None, None: None}
    df = spark.createDataFrame([(k,) for k in forms], "t string").select("t", RD.parse_timestamp(F.col("t")).alias("p"))
    for r in df.collect():
        want = forms[r["t"]]
        assert r["p"] == (want and dt.datetime(2025, 10, 15, *want)), r
    with pytest.raises(Exception, match="not a timestamp"):
        spark.createDataFrame([("yesterday",)], "t string").select(RD.parse_timestamp(F.col("t"))).collect()


def test_hand_made_post_file(spark, tmp_path):
    (tmp_path / "p.csv").write_text('tweet_id,author_id,tweet_text,created_at,lang,source,like_count,retweet_count,sentiment\n'
                                    '7,8,"two\nlines, ""quoted""",2025-10-15 19:08:51+00:00,en,,3,0,\n')
    r = RD.read_posts_csv(spark, str(tmp_path / "p.csv")).collect()[0]
    assert (r["tweet_id"], r["tweet_text"], r["created_at"]) == (7, 'two\nlines, "quoted"', dt.datetime(2025, 10, 15, 19, 8, 51))


def test_first_per_key_order(spark):
    b = spark.createDataFrame([(1, "late", 2), (1, "early", 1)], "tweet_id long, t string, seq int")
    got = I.first_per_key(b, "tweet_id", [F.col("seq")]).collect()
    assert got[0]["t"] == "early"


def test_flatten_missing_metrics(spark):
    raw = spark.createDataFrame([(1, None, "x", None, None, None, None)], S.RAW_POST)
    r = I.flatten_records(raw).collect()[0]
    assert (r["like_count"], r["retweet_count"], r["sentiment"]) == (0, 0, None)


def test_csv_multiline_roundtrip_and_sinks(spark):
    path = scratch_path(spark, "csv")
    rows = [(1, 5, 'line1\nline2 "quoted", comma', dt.datetime(2025, 10, 15, 16, 16, 12, 123456),
             "en", None, 1, 0, None)]
    df = spark.createDataFrame(rows, S.POSTS)
    W.write_csv(df, path)
    back = RD.read_posts_csv(spark, path).collect()
    assert back == df.collect()
    sp = scratch_path(spark, "summaries")
    W.append_summary(spark, spark.createDataFrame([("s1",)], "summary string"), sp)
    W.append_summary(spark, spark.createDataFrame([("s2",)], "summary string"), sp)
    latest = R.latest_row(spark.read.parquet(sp).withColumn("k", F.lit(0)), "generated_at", "k", ["summary"])
    assert latest.count() == 1
    tp = scratch_path(spark, "latest")
    W.write_latest_text(spark.createDataFrame([("final words",)], "summary string"), tp)
    assert spark.read.text(tp).collect()[0]["value"] == "final words"
    cp = scratch_path(spark, "created")
    assert W.create_table_if_absent(spark, cp, S.SUMMARIES) is True
    assert W.create_table_if_absent(spark, cp, S.SUMMARIES) is False
    assert spark.read.parquet(cp).schema.names == S.SUMMARIES.names


def test_search_parse():
    q = I.parse_search("fed rate cut lang:en -is:retweet")
    assert q == {"terms": ["fed", "rate", "cut"], "lang": "en", "no_reposts": True}


def test_network_exports_and_metrics_reread(spark):
    from chirpscope.operators import graph as G
    me = spark.createDataFrame([("user:1", "@a", 2)], "source string, target string, weight long")
    he = spark.createDataFrame([], "node_u string, node_v string, weight long")
    nodes = spark.createDataFrame([("@a", 1, 0.0, 0.5, "mention", "user")], S.NODE_METRICS)
    base = scratch_path(spark, "net")
    paths = {k: f"{base}/{k}" for k in
             ("mention_edges", "hashtag_edges", "nodes_metrics", "top_accounts", "top_hashtags")}
    top = G.top_nodes(nodes, ["user", "user_id"])
    W.export_network(paths, me, he, nodes, top, top.drop("node_type"))
    local = {k: v.replace("file:", "", 1) for k, v in paths.items()}
    assert not os.path.exists(local["hashtag_edges"])          # empty edge table not written
    back = RD.read_node_metrics_csv(spark, paths["nodes_metrics"]).collect()
    assert back == nodes.collect()
    assert len([f for f in os.listdir(local["top_accounts"]) if f.endswith(".csv")]) == 1


def test_a_text_of_null_ids_stays(spark):
    t = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([(None, "only null", t), (None, "only null", t), (None, "both", t), (4, "both", t), (3, "both", None)],
                               "tweet_id long, clean_text string, created_at timestamp_ntz")
    got = sorted((r["clean_text"], r["tweet_id"]) for r in SM.unique_texts(df).collect())
    assert got == [("both", 4), ("only null", None)]

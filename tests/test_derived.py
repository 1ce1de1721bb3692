"""Word index, zone maps and daily partials against the plain operators over the whole table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chirpscope.operators import ingest as I
from chirpscope.operators import report as R
from chirpscope.operators import summarize as SM
from chirpscope.session import scratch_path
from chirpscope.sources.commit_log import CommitLog
from chirpscope.sources.derived import Derived
from chirpscope.sources.partials import DailyPartials
from chirpscope.sources.search_index import SearchIndex, intersect, postings
from chirpscope.sources.writers import insert_if_new
from chirpscope.sources.zone_maps import ZoneMap

POSTS = "tweet_id long, tweet_text string, lang string, created_at timestamp_ntz, label string, score double"
WORDS = ["fed", "Rate", "CUT", "data-driven", "#fed", "c++", "naïve", "ſo", "İx", "日本", "a_b", "9", "fedrate", "RT", "fed's", "²"]


def post(rng, key):
    text = rng.choice([None, "", " ".join(rng.choices(WORDS, k=rng.randint(1, 9))), ",".join(rng.choices(WORDS, k=4)),
                       "RT @x " + " ".join(rng.choices(WORDS, k=6))])
    ts = rng.choice([None, dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randint(0, 400))])
    return key, text, rng.choice(["en", "de", None]), ts, rng.choice(["positive", "negative", "neutral", None]), rng.choice(
        [None, float("nan"), rng.randint(-8, 8) / 4])


def filled(spark, commits, name="derived"):
    log = CommitLog(spark, scratch_path(spark, name))
    for i, rows in enumerate(commits):
        log.append_new(spark.createDataFrame(rows, POSTS), "tweet_id", str(i), "test", -1)
    return log


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def posts(spark):
    """Three commits; ids around the ends of a block, negative, very large and missing."""
    rng = random.Random(4)
    keys = [None, -1, -32768, -32769, 0, 32767, 32768, 2 ** 62 + 5, -2 ** 63] + list(range(100, 250))
    rows = [post(rng, k) for k in keys]
    return [rows[0::3], rows[1::3], rows[2::3]]


@pytest.mark.parametrize("refreshed", [2, 3])
def test_search_through_the_index(spark, posts, refreshed):
    log = CommitLog(spark, scratch_path(spark, "search"))
    index = SearchIndex(log)
    assert index.search("fed") is None
    for i, rows in enumerate(posts):
        log.append_new(spark.createDataFrame(rows, POSTS), "tweet_id", str(i), "test", -1)
        if i < refreshed:
            assert index.refresh() == 1 and index.refresh() == 0
    whole = log.read()
    for q in ("fed", "fed rate cut lang:en -is:retweet", "data-driven", "#fed", "c++ lang:de", "NAÏVE 日本", "ſo", "İx", "a_b 9",
              "fed's", "lang:en", "nowhere", "fed nowhere", "++", "fed fed FED", "²", "*."):
        assert rows_of(index.search(q)) == rows_of(I.search_posts(whole, q)), q
    assert rows_of(index.search("fed", max_results=3)) == rows_of(I.search_posts(whole, "fed", max_results=3))


def test_a_search_reads_only_commits_with_candidates(spark):
    t = dt.datetime(2024, 1, 1)
    log = filled(spark, [[(k, text, "en", t, None, 0.0) for k in range(i * 10, i * 10 + 10)]
                         for i, text in enumerate(("fed and rate", "fed alone", "rate alone", "fed cut rate"))])
    index = SearchIndex(log)
    index.refresh()
    folders, ids = index.candidates(index.query_words("fed rate"), index.derived.snapshot().derived)
    assert sorted(r[0] for r in ids.collect()) == [*range(10), *range(30, 40)]
    names = [c["folder"] for c in log.commits()]
    assert sorted(folders) == sorted([names[0], names[3]])
    assert {f.split("/")[-2] for f in index.search("fed rate").inputFiles() if "/data/" in f} == set(folders)


def test_lists_stay_within_a_block(spark):
    """A word in every post is cut into lists of one block each, sorted."""
    log = CommitLog(spark, scratch_path(spark, "blocks"))
    n = 3 * 32768 + 7
    log.append_new(spark.range(n).select(F.col("id").alias("tweet_id"), F.lit("fed rate").alias("tweet_text")), "tweet_id", "0", "test", -1)
    lists = postings(log.read()).cache()
    assert lists.count() == 8 and lists.agg(F.max(F.size("at"))).first()[0] == 32768
    assert lists.where(F.col("at") != F.sort_array("at")).count() == 0
    words = [r[0] for r in lists.select("word").distinct().collect()]
    assert intersect(lists, words).select("tweet_id").distinct().count() == n
    lists.unpersist()


def test_two_refreshers_cover_a_folder_once(spark, posts):
    log = filled(spark, posts[:2], "two")
    a, b = SearchIndex(log), SearchIndex(log)
    claim = b.derived.log.claim
    raced = []

    def late(version, commit):            # the other refresher commits first
        if not raced:
            raced.append(a.refresh())
            log.append_new(spark.createDataFrame(posts[2], POSTS), "tweet_id", "2", "test", -1)
        return claim(version, commit)

    b.derived.log.claim = late
    assert b.refresh() == 1 and raced == [2]
    covers = [f for c in b.derived.log.commits() for f in c["covers"]]
    assert sorted(covers) == sorted(c["folder"] for c in log.commits()) and len(covers) == 3
    assert rows_of(b.search("fed")) == rows_of(I.search_posts(log.read(), "fed"))


@pytest.mark.parametrize("refreshed", [0, 2, 3])
def test_newest_through_zone_maps(spark, posts, refreshed):
    log = CommitLog(spark, scratch_path(spark, "newest"))
    zone = ZoneMap(log)
    assert zone.newest(3) is None
    for i, rows in enumerate(posts):
        log.append_new(spark.createDataFrame(rows, POSTS).repartition(3), "tweet_id", str(i), "test", -1)
        if i < refreshed:
            zone.refresh()
    for k in (0, 1, 7, 40, 1000):
        got = [r["created_at"] for r in zone.newest(k).collect()]
        want = SM.newest_k(log.read(), k=k)
        assert got == [r["created_at"] for r in want.collect()]
        assert rows_of(zone.newest(k)) == rows_of(want), k


def test_old_files_are_not_opened(spark):
    day = dt.datetime(2024, 1, 1)
    log = filled(spark, [[(i * 100 + h, "t", "en", day + dt.timedelta(days=i, hours=h), None, 0.0) for h in range(24)]
                         for i in range(6)], "old")
    zone = ZoneMap(log)
    zone.refresh()
    newest, whole = zone.newest(30), log.read()
    assert rows_of(newest) == rows_of(SM.newest_k(whole, k=30))
    assert len({f.split("/")[-2] for f in newest.inputFiles()}) == 2 and len({f.split("/")[-2] for f in whole.inputFiles()}) == 6


def test_ties_at_the_edge_are_all_seen(spark):
    t = dt.datetime(2024, 1, 1)
    log = filled(spark, [[(k, "t", "en", t, None, 0.0) for k in ks] for ks in ((9, 8), (1, 7), (3, 2))], "ties")
    zone = ZoneMap(log)
    zone.refresh()
    assert [r["tweet_id"] for r in zone.newest(3).collect()] == [1, 2, 3]


@pytest.mark.parametrize("refreshed", [0, 2, 3])
def test_partials_equal_the_full_scan(spark, posts, refreshed):
    log = CommitLog(spark, scratch_path(spark, "partials"))
    daily = DailyPartials(log, "created_at", "label", "score")
    assert daily.merged() is None and daily.value_counts() is None
    for i, rows in enumerate(posts):
        log.append_new(spark.createDataFrame(rows, POSTS), "tweet_id", str(i), "test", -1)
        if i < refreshed:
            daily.refresh()
    whole = log.read()
    counts = R.value_counts(whole, "label").withColumnRenamed("label", "class")
    assert daily.value_counts().collect() == counts.collect()
    assert daily.class_totals().collect() == R.class_totals(whole, "label").collect()
    assert daily.daily_mean().collect() == R.daily_mean(whole, "created_at", "score").collect()
    assert daily.date_bounds().collect() == R.date_bounds(whole, "created_at").collect()
    assert daily.merged().agg(F.sum("n")).first()[0] == whole.count()


def test_a_refresh_reads_new_commits_alone(spark, posts):
    log = filled(spark, posts[:2], "alone")
    seen = []

    def derive(rows):
        seen.append({f.split("/")[-2] for f in rows.inputFiles()})
        return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))

    d = Derived(log, "by-lang", derive)
    assert d.refresh() == 2
    log.append_new(spark.createDataFrame(posts[2], POSTS), "tweet_id", "2", "test", -1)
    assert d.refresh() == 1 and d.refresh() == 0
    names = [c["folder"] for c in log.commits()]
    assert seen == [set(names[:2]), {names[2]}]


def test_inserts_bring_their_followers_up_to_date(spark, posts):
    path = scratch_path(spark, "followed")
    for rows in posts:
        insert_if_new(spark, spark.createDataFrame(rows, POSTS), path, followers=[SearchIndex, ZoneMap])
    log = CommitLog(spark, path)
    assert not SearchIndex(log).derived.snapshot().pending and not ZoneMap(log).derived.snapshot().pending
    assert rows_of(SearchIndex(log).search("fed")) == rows_of(I.search_posts(log.read(), "fed"))

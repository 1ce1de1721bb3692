"""Search through a word index (SRC8, FN11).

    (word, folder, block, at)    word: 64-bit hash of a lower-cased word; block: id >> 15;
                                 at: sorted 2-byte offsets of the ids in that block

A list holds at most 32,768 ids, so a word that every post holds is many short lists, spread over
the tasks.  Lists are stored in (word, block) order: the footers of the index tell which files and
row groups can hold a word, and ``word IN (...)`` is pushed down to them.

A search intersects the lists of all its words block by block, the shortest first, reads only the
commits that still have an id, and puts the plain search's regexes to those rows alone.  Words
are found with the rule of ``has_word``, so a matching post holds every word of every term; equal
hashes of different words only add candidates.  Rows without an id can't be listed: a row without a
word names each folder that holds some, and they are read from there by a pushed ``IS NULL``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpscope import constants as C
from chirpscope.functions import text as TX
from chirpscope.operators.ingest import parse_search, search_posts
from chirpscope.session import scratch_path
from chirpscope.sources.commit_log import CommitLog
from chirpscope.sources.derived import Derived, folder_name

#: Ids of a block have the same ``id >> BLOCK_BITS``; offsets fit a short.
BLOCK_BITS = 15
WORD = r"[\p{L}\p{N}_]+"


def _words(lowered: Column) -> Column:
    """Hashes of the distinct words of a lower-cased text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)))


def postings(posts: DataFrame, text_col: str = "tweet_text", id_col: str = "tweet_id") -> DataFrame:
    """(word, folder, block, at) of rows read from a commit log."""
    i = F.col(id_col).cast("long")
    each = posts.where(F.col(id_col).isNotNull()).select(
        folder_name().alias("folder"), F.shiftright(i, BLOCK_BITS).alias("block"),
        i.bitwiseAND((1 << BLOCK_BITS) - 1).cast("short").alias("at"),
        F.explode(_words(F.lower(TX.text_or_empty(text_col)))).alias("word"))
    lists = each.groupBy("word", "folder", "block").agg(F.sort_array(F.collect_set("at")).alias("at"))
    unlisted = posts.where(F.col(id_col).isNull()).select(folder_name().alias("folder")).distinct().select(
        F.lit(None).cast("long").alias("word"), "folder", F.lit(None).cast("long").alias("block"),
        F.array().cast("array<smallint>").alias("at"))
    return lists.unionByName(unlisted).repartitionByRange("word", "block").sortWithinPartitions("word", "block")


def intersect(lists: DataFrame, words: list[int], id_col: str = "tweet_id") -> DataFrame:
    """(folder, id) of the posts that are on the lists of all these words."""
    sized = F.struct(F.size("at").alias("n"), F.col("at"))
    per_block = (lists.where(F.col("word").isin(words)).groupBy("folder", "block")
                 .agg(F.sort_array(F.collect_list(sized)).alias("lists")).where(F.size("lists") == len(words)))
    common = F.aggregate(F.slice("lists", 2, len(words)), F.col("lists")[0]["at"], lambda left, x: F.array_intersect(left, x["at"]))
    return (per_block.select("folder", "block", F.explode(common).alias("at"))
            .select("folder", (F.shiftleft("block", BLOCK_BITS) + F.col("at")).alias(id_col)))


class SearchIndex:
    """The word index of one table of posts."""

    def __init__(self, table: CommitLog, text_col: str = "tweet_text", id_col: str = "tweet_id"):
        self.table, self.id_col = table, id_col
        self.derived = Derived(table, f"words-{text_col}", lambda rows: postings(rows, text_col, id_col))

    def refresh(self) -> int:
        return self.derived.refresh()

    def query_words(self, query: str) -> list[int]:
        """Hashes of the words that a match must hold.  Spark cuts them, as it cut the posts."""
        terms = [t.lower() for t in parse_search(query)["terms"]]
        if not terms:
            return []
        words = F.array_distinct(F.flatten(F.array(*[_words(F.lit(t)) for t in terms])))
        return list(self.table.spark.range(1).select(words.alias("w")).first()["w"])

    def lists(self, derived: list[dict]) -> DataFrame:
        return self.table.spark.read.parquet(*self.derived.log.folders(derived))

    def candidates(self, words: list[int], derived: list[dict]) -> tuple[list[str], DataFrame]:
        """The folders and ids that hold all of ``words``.  The ids are written down; the driver gets
        the folders, which its log lists anyway."""
        path = scratch_path(self.table.spark, "search-ids")
        intersect(self.lists(derived), words, self.id_col).write.parquet(path)
        ids = self.table.spark.read.schema(f"folder string, {self.id_col} long").parquet(path)
        return [r[0] for r in ids.select("folder").distinct().collect()], ids.select(self.id_col)

    def without_id(self, derived: list[dict]) -> list[str]:
        """The folders that hold rows without an id."""
        return [r[0] for r in self.lists(derived).where(F.col("word").isNull()).select("folder").distinct().collect()]

    def search(self, query: str = C.DEFAULT_SEARCH, max_results: int | None = None,
               is_repost: Column | None = None) -> DataFrame | None:
        """The rows of ``search_posts`` over the whole table; None if nothing was committed."""
        words, seen = self.query_words(query), self.derived.snapshot()
        table = self.table.read()
        if table is None:
            return None
        if not words or not self.derived.log.folders(seen.derived):
            return search_posts(table, query, max_results, is_repost)
        folders, ids = self.candidates(words, seen.derived)

        def of(names: list[str]) -> list[dict]:
            return [c for c in seen.covered if c["folder"] in set(names)]

        hit, bare = of(folders), of(self.without_id(seen.derived))
        parts = [self.table.read(hit).join(ids, self.id_col, "left_semi").select(*table.columns)] if hit else []
        if bare:
            parts.append(self.table.read(bare).where(F.col(self.id_col).isNull()))
        if seen.pending:
            parts.append(self.table.read(seen.pending))
        if not parts:
            return search_posts(table.where(F.lit(False)), query, max_results, is_repost)
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return search_posts(rows, query, max_results, is_repost)

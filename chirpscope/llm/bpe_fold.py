"""Byte-level BPE with Spark's higher-order functions: ranked merges folded over byte arrays.

A text is cut into words by the vocabulary's pattern.  A word is an array of byte ids, next to an
array of the ranks at which its neighbouring pairs merge.  ``aggregate`` folds over it: each step
takes the lowest rank (the leftmost one on ties), merges that pair and asks the rank map for the two
pairs that changed.  The rank map is a literal of the plan: arrays addressed by a perfect hash
(``PerfectHash``), so that a pair costs a few array reads however large the vocabulary.

Words repeat, so a second literal holds the ids of up to ``CACHE_WORDS`` distinct words, folded
once: the most frequent ones of about ``CACHE_DOCS`` documents.  Words that it lacks are folded where
they stand; which words it holds changes the time, never an id.  No text is shuffled, and what the
driver collects and the plan carries is bounded by these two parameters and the vocabulary.

Decoding reads each id's bytes from a third literal and concatenates the pieces.

Cases: null text is empty and has no ids; any other text round-trips to its UTF-8 bytes; an id that
the vocabulary lacks makes a decoded value null; repeated rows and ids stay rows of their own; other
columns are never read; an empty table gives an empty result.  One unbroken run of n letters without
any cut of the pattern takes n rounds over n entries: quadratic in the run, never in the text.
"""

from __future__ import annotations

import base64
import json
import struct
import zlib
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct words whose ids the plan carries (some 150 bytes each in a task).
CACHE_WORDS = 200_000
#: Documents in which those words are counted.
CACHE_DOCS = 10_000
#: Rank of a pair that does not merge, and mark of a pair not looked up yet.
NEVER, UNKNOWN = 2 ** 31 - 1, -1
#: A pair is one number, its rank above its place: the smallest one is the leftmost of the lowest rank.
PLACE_BITS = 31
PLACES = 1 << PLACE_BITS


def multi_bpe() -> str:
    """The public rank file for many languages."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def word_pattern() -> str:
    """The public pattern that cuts text into words."""
    import public_tokenizers
    return public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a tiktoken file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


# --- literals ----------------------------------------------------------------------------


def literal(values, kind: str) -> Column:
    """A constant array: parsed once, when the plan is optimised."""
    return F.from_json(F.lit(json.dumps(values, ensure_ascii=False)), kind)


def let(value: Column, body: Callable[[Column], Column], like: Column) -> Column:
    """``body`` of a value that is evaluated once; ``like`` is any column of its type.  (An element
    taken from ``transform`` would do, but finds out its type anew at every evaluation.)"""
    return F.aggregate(F.array(value), like, lambda _, x: body(x))


def bucketed(entries: Iterable[tuple[int, str]], buckets: int, kind: str) -> Column:
    """(bucket, JSON of a key and its value) entries as a constant array of small maps, null where
    empty: the literal map in which a look-up costs the same at any size.  Text is put to text: the
    driver holds no object of a key or a value."""
    out = [""] * buckets
    for b, entry in entries:
        out[b] += "," + entry
    text = "[" + ",".join("{" + x[1:] + "}" if x else "null" for x in out) + "]"
    return F.from_json(F.lit(text), f"array<map<string,{kind.split(',', 1)[1]}>").cast(f"array<{kind}>")


class Vocabulary:
    """A rank file as constant columns."""

    #: Small maps that the pairs are dealt to, and the multiplier of the left id.
    BUCKETS, LEFT = 65_521, 7919

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        size = max(self.ranks.values()) + 1
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        if size > 1 << 17:
            raise ValueError("more than 131072 ids")
        merges = {}
        for token, r in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    merges[a, b] = r
        self._pairs = bucketed((((a * self.LEFT + b) % self.BUCKETS, f'"{a << 17 | b}":{r << PLACE_BITS}') for (a, b), r in merges.items()),
                               self.BUCKETS, "map<bigint,bigint>")
        # the upper byte of CRC-32 differs for all single bytes: a number for each byte
        first = [0] * 256
        for b in range(256):
            first[zlib.crc32(bytes([b])) >> 24] = self.ranks[bytes([b])]
        self._bytes = literal(first, "array<int>")
        piece = [None] * size
        for token, r in self.ranks.items():
            piece[r] = token.hex()
        self._pieces = literal(piece, "array<string>")
        self._little = literal([struct.pack("<I", i).hex() for i in range(size)], "array<string>")
        self._whole = self._odd_tokens(merges)

    def _odd_tokens(self, merges: dict) -> dict[str, int]:
        """Tokens that are no result of their own bytes' merges; a word that is one is that token."""
        odd = {}
        for token, r in self.ranks.items():
            ids = [self.ranks[bytes([b])] for b in token]
            while len(ids) > 1:
                at = [merges.get(p, NEVER) for p in zip(ids, ids[1:])]
                low = min(at)
                if low == NEVER:
                    break
                k = at.index(low)
                ids[k:k + 2] = [low]
            if ids != [r]:
                try:
                    odd[token.decode()] = r
                except UnicodeDecodeError:       # no word of a text
                    pass
        return odd

    def _rank(self, left: Column, right: Column) -> Column:
        """The rank of a pair, above ``PLACE_BITS`` bits."""
        bucket = F.get(self._pairs, (left * self.LEFT + right) % self.BUCKETS)
        rank = F.element_at(bucket, F.shiftleft(left.cast("long"), 17) + right)
        return F.coalesce(rank, F.lit(NEVER * PLACES))

    def word_ids(self, word: Column) -> Column:
        """Ids of a non-empty word: the fold.  Its state is the ids, and the rank of each pair."""
        def start(raw: Column) -> Column:
            ids = F.transform(F.sequence(F.lit(1), F.octet_length(raw)),
                              lambda i: F.get(self._bytes, F.shiftright(F.crc32(raw.substr(i, F.lit(1))), 24).cast("int")))
            return F.struct(ids.alias("ids"), F.array_repeat(F.lit(UNKNOWN).cast("long"), F.octet_length(raw) - 1).alias("pairs"))

        def step(state: Column, _: Column) -> Column:
            ids = state["ids"]

            def ranked(x: Column, i: Column) -> Column:
                return F.when(x >= 0, x.bitwiseAND(-PLACES)).otherwise(self._rank(F.get(ids, i), F.get(ids, i + 1))) + i

            def merge(pairs: Column, low: Column, p: Column) -> Column:
                left = F.filter(F.transform(ids, lambda x, i: F.when(i == p, F.shiftright(low, PLACE_BITS).cast("int")).otherwise(x)),
                                lambda x, i: i != p + 1)
                rest = F.filter(F.transform(pairs, lambda x, i: F.when(F.abs(i - p) == 1, F.lit(UNKNOWN).cast("long")).otherwise(x)),
                                lambda x, i: i != p)
                return F.struct(left.alias("ids"), rest.alias("pairs"))

            def merged(pairs: Column) -> Column:
                return let(F.array_min(pairs), lambda low: F.when(low < NEVER * PLACES, let(
                    low.bitwiseAND(PLACES - 1).cast("int"), lambda p: merge(pairs, low, p), state)).otherwise(
                    F.struct(ids.alias("ids"), pairs.alias("pairs"))), state)

            return let(F.transform(state["pairs"], ranked), merged, state)

        folded = let(word.cast("binary"), lambda raw: F.aggregate(
            F.sequence(F.lit(2), F.greatest(F.octet_length(raw), F.lit(2))), start(raw), step, lambda s: s["ids"]),
            F.array().cast("array<int>"))
        if self._whole:
            odd = F.create_map(*[x for w, r in sorted(self._whole.items()) for x in (F.lit(w), F.array(F.lit(r)))])
            folded = F.coalesce(odd[word], folded)
        return folded

    def text_ids(self, text: Column, pattern: str, cache: Callable[[Column], Column] | None = None) -> Column:
        """Ids of a text (null: none)."""
        one = (lambda w: F.coalesce(cache(w), self.word_ids(w))) if cache else self.word_ids
        return F.flatten(F.transform(words(text, pattern), one))

    def little_endian(self, ids: Column) -> Column:
        """Ids as little-endian unsigned 32-bit integers."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self._little, i)), "", "x"))

    def decode(self, ids: Column) -> Column:
        """Bytes of an array of ids; null if the vocabulary lacks one of them."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self._pieces, i)), "", "x"))


def words(text: Column, pattern: str) -> Column:
    """All matches of the pattern, with Unicode's white space."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))


def cached_words(docs: DataFrame, vocabulary: Vocabulary, pattern: str, text_col: str = "text",
                 n_words: int | None = None, n_docs: int | None = None) -> Callable[[Column], Column]:
    """A column function that gives the ids of the most frequent words, null for any other word."""
    n_words, n_docs = n_words or CACHE_WORDS, n_docs or CACHE_DOCS
    rows = docs.count()
    some = docs.select(F.col(text_col).alias("text"))
    if rows > n_docs:
        some = some.sample(n_docs / rows, seed=11)
    top = (some.select(F.explode(words(F.col("text"), pattern)).alias("word")).groupBy("word").count()
           .orderBy(F.desc("count"), "word").limit(n_words).select("word"))
    buckets = max(1, n_words // 4)
    entry = F.to_json(F.create_map("word", vocabulary.word_ids(F.col("word"))))
    # both are named: a column without a name bears its whole expression, rank map included, as its name
    rows = top.select((F.xxhash64("word").bitwiseAND(2 ** 62 - 1) % buckets).alias("bucket"),
                      F.substr(entry, F.lit(2), F.length(entry) - 2).alias("entry")).toLocalIterator()
    known = bucketed(rows, buckets, "map<string,array<int>>")
    return lambda word: F.element_at(F.get(known, F.xxhash64(word).bitwiseAND(2 ** 62 - 1) % buckets), word)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id",
           text_col: str = "text", vocabulary: Vocabulary | None = None) -> DataFrame:
    """doc_id, ids: one row per row of ``docs``."""
    vocabulary = vocabulary or Vocabulary(path or multi_bpe())
    pattern = pattern or word_pattern()
    cache = cached_words(docs, vocabulary, pattern, text_col)
    # every task unpacks the literals once: few large tasks, at least two a core
    parts = docs.rdd.getNumPartitions()
    docs = docs.coalesce(max(1, min(parts, max(2 * docs.sparkSession.sparkContext.defaultParallelism, parts // 4))))
    return docs.select(F.col(id_col).alias("doc_id"), vocabulary.text_ids(F.col(text_col), pattern, cache).alias("ids"))


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes that they decode to."""
    vocabulary = Vocabulary(path or multi_bpe())
    coded = encode(docs, None, pattern, id_col, text_col, vocabulary)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(vocabulary.little_endian(F.col("ids")), 256).alias("ids_sha256"),
                        F.sha2(vocabulary.decode(F.col("ids")), 256).alias("decoded_sha256"))

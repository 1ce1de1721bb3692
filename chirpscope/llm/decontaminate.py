"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by documents: a *shard* is a few megabytes of consecutive rows and
holds, for every indexed term, the sorted word positions at which it occurs.  Shards are written
to a shared table (``build_index``) and searched one by one (``search``), so neither building nor
searching moves postings between tasks and a frequent term is cut by the shards it occurs in.

A search looks at each window of test words: its terms are ordered by the length of their lists
in the shard, the list of the rarest gives the candidates, and each further list, adjusted by
its offset, is intersected with them until none is left.  Candidates that meet every list exactly
are phrase matches; those that meet every list within ``slop`` positions are proximity matches.

Test items are a query set: they go to the tasks in blocks of at most ``block_bytes`` of text, so
what a task receives is bounded whatever the number of items.

Terms are 64-bit fingerprints; two given words agree with a probability of about 2**-64.

Cases: null or word-less texts have 0 words and no hit; items without words have no window; equal
items and rows are handled one by one, an item id counts once per document (a null id as
``null``); other columns are ignored; an empty table on either side gives no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpscope.llm import common as U

WINDOW = 10
SLOP = 2
#: Unused positions between two documents: no window, however loose, reaches across.
GAP = 16
BLOCK_BYTES = 16 << 20

SHARD = ("part int, seq int, doc_ids array<long>, n_words array<long>, base array<long>, "
         "terms binary, lens binary, positions binary")
HITS = ("part int, seq int, nth int, doc_id long, n_words long, starts array<long>, ends array<long>, "
        "items array<string>, near array<string>")


def terms_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words of all texts, and the number of words of each."""
    data = U.LOWER[data]
    s, e, n = U.word_spans(data, off, U.ALNUM)
    return U.Prints(data).of(s, e), n


# --- items -----------------------------------------------------------------------------


class Windows:
    """Distinct windows of the items of one block."""

    def __init__(self, ids: list[str], texts: pa.Array, size: int):
        terms, n = terms_of(*U.text_bytes(texts))
        at, found = 0, {}
        for name, k in zip(ids, n):
            words = terms[at:at + k].tolist()
            at += k
            for i in range(max(1, k - size + 1) if k else 0):
                found.setdefault(tuple(words[i:i + size]), set()).add(name)
        self.windows = list(found)
        self.items = [sorted(x) for x in found.values()]
        self.vocabulary = np.unique(terms)


def item_blocks(items: DataFrame, id_col: str, text_col: str, size: int, block_bytes: int) -> Iterator[Windows]:
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = int(2 * total // block_bytes) + 1
    for k in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k) if blocks > 1 else rows
        got = part.toArrow()
        yield Windows(got.column("id").to_pylist(), got.column("text"), size)


# --- index ------------------------------------------------------------------------------


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                vocabulary: np.ndarray | None = None) -> DataFrame:
    """Shards of the positional index of ``docs``, stored.  ``vocabulary``: terms that will ever
    be asked for (None: all); postings of others are never read by a search."""
    U.small_batches(docs.sparkSession)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for seq, b in enumerate(U.bulk(batches, "text")):
            terms, n = terms_of(*U.text_bytes(b.column("text")))
            base = np.cumsum(n + GAP) - n - GAP
            position = np.arange(len(terms)) + GAP * np.repeat(np.arange(len(n)), n)
            if vocabulary is not None:
                k = np.minimum(np.searchsorted(vocabulary, terms), max(0, len(vocabulary) - 1))
                keep = vocabulary[k] == terms if len(vocabulary) else np.zeros(len(terms), bool)
                position, group = position[keep], k[keep]
                order = np.argsort(group.astype(np.uint16 if len(vocabulary) < 1 << 16 else np.int64), kind="stable")
                used = np.bincount(group, minlength=len(vocabulary))
                names, lens = vocabulary[used > 0], used[used > 0]
            else:
                order = np.argsort(terms, kind="stable")
                names, lens = np.unique(terms, return_counts=True)
            wide = np.int64 if len(position) and position[-1] >= 1 << 32 else np.uint32
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "doc_ids": pa.array([b.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                "n_words": pa.array([n], pa.list_(pa.int64())), "base": pa.array([base], pa.list_(pa.int64())),
                "terms": pa.array([names.astype("<u8").tobytes()], pa.binary()),
                "lens": pa.array([lens.astype("<u8").tobytes()], pa.binary()),
                "positions": pa.array([position[order].astype(wide).astype("<i8" if wide is np.int64 else "<u4").tobytes()], pa.binary())})

    return U.stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                    .mapInArrow(shards, SHARD), "postings")


# --- search -----------------------------------------------------------------------------


def within(values: np.ndarray, wanted: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each wanted position: is it in the sorted list, and is one within ``slop`` of it."""
    k = np.searchsorted(values, wanted - slop)
    near = values[np.minimum(k, len(values) - 1)]
    near = (near >= wanted - slop) & (near <= wanted + slop)
    k = np.searchsorted(values, wanted)
    return values[np.minimum(k, len(values) - 1)] == wanted, near


def match(lists: list[np.ndarray], slop: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts of exact and of proximity matches, from the rarest list on."""
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    start = lists[order[0]].astype(np.int64) - order[0]
    exact = np.ones(len(start), bool)
    for i in order[1:]:
        same, near = within(lists[i], start + i, slop)
        start, exact = start[near], (exact & same)[near]
        if not len(start):
            break
    return start[exact], start


def search(index: DataFrame, items: Windows, slop: int = SLOP) -> DataFrame:
    """Per document with its row's place: word count, hit intervals (word ordinals), items with
    exact and with proximity matches."""
    if slop >= GAP:
        raise ValueError(f"slop must be under {GAP}")
    asked, names = items.windows, items.items

    def one(r: dict) -> pa.RecordBatch:
        n_words, base = np.array(r["n_words"], np.int64), np.array(r["base"], np.int64)
        terms, lens = np.frombuffer(r["terms"], "<u8"), np.frombuffer(r["lens"], "<u8").astype(np.int64)
        held = np.frombuffer(r["positions"], "<u4" if len(r["positions"]) == 4 * lens.sum() else "<i8").astype(np.int64)
        where = dict(zip(terms.tolist(), zip((np.cumsum(lens) - lens).tolist(), np.cumsum(lens).tolist())))
        marks = np.zeros(int((n_words + GAP).sum()) + GAP, np.int32)
        exact_items: list[set] = [set() for _ in n_words]
        near_items: list[set] = [set() for _ in n_words]
        for window, owners in zip(asked, names):
            if not all(t in where for t in window):
                continue
            exact, near = match([held[slice(*where[t])] for t in window], slop)
            np.add.at(marks, exact, 1)
            np.add.at(marks, exact + len(window), -1)
            for found, sets in ((exact, exact_items), (near, near_items)):
                for d in np.unique(np.searchsorted(base, found, "right") - 1):
                    sets[max(0, d)].update(owners)
        hit = np.cumsum(marks) > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        a, b = edge[::2], edge[1::2]
        doc = np.searchsorted(base, a, "right") - 1
        offs = np.searchsorted(doc, np.arange(len(n_words) + 1)).astype(np.int32)
        nested = lambda x: pa.ListArray.from_arrays(offs, pa.array(x.astype(np.int64)))
        listed = lambda sets: pa.array([sorted(s) for s in sets], pa.list_(pa.string()))
        return pa.RecordBatch.from_pydict({
            "part": pa.array([r["part"]] * len(n_words), pa.int32()), "seq": pa.array([r["seq"]] * len(n_words), pa.int32()),
            "nth": pa.array(np.arange(len(n_words)), pa.int32()), "doc_id": pa.array(r["doc_ids"], pa.int64()),
            "n_words": n_words, "starts": nested(a - base[doc]), "ends": nested(b - base[doc]),
            "items": listed(exact_items), "near": listed(near_items)})

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                yield one(b.slice(k, 1).to_pylist()[0])

    index.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    return index.mapInArrow(searched, HITS)


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
         slop: int = SLOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: n_words, merged hit intervals, item ids (exact and proximity)."""
    blocks = list(item_blocks(items, item_id, item_text, window, block_bytes))
    one = len(blocks) == 1
    vocabulary = blocks[0].vocabulary if one else None
    index = build_index(docs, id_col, text_col, vocabulary)
    found = None
    for b in blocks:
        part = search(index, b, slop)
        found = part if found is None else found.unionByName(part)
    if one:
        return found.drop("part", "seq", "nth")
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    runs = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))
    merged = F.aggregate(
        "_r", F.array().cast("array<struct<starts:bigint,ends:bigint>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["ends"] >= x["starts"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1)["starts"].alias("starts"),
                                  F.greatest(F.element_at(acc, -1)["ends"], x["ends"]).alias("ends")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["starts"].alias("starts"), x["ends"].alias("ends"))))))
    out = (found.groupBy("part", "seq", "nth").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), runs.alias("_r"),
        flat("items").alias("items"), flat("near").alias("near")).withColumn("_r", merged))
    return out.select("doc_id", "n_words", F.col("_r.starts").alias("starts"), F.col("_r.ends").alias("ends"), "items", "near")


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda acc, x: acc + x)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"), F.size("near").cast("long").alias("n_near_items"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Documents without any hit, all columns kept.  A row is known by a fingerprint of its id
    and text, so rows that share an id are judged one by one; the fingerprints of contaminated
    rows are stored first, so Spark knows their size when it chooses the join."""
    key, (name,) = F.xxhash64(id_col, text_col), U.free_names(docs, "__key")
    bad = U.stored(hits(docs.select(key.alias("doc_id"), F.col(text_col).alias("text")), items, **options)
                   .filter(F.size("starts") > 0).select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return docs.withColumn(name, key).join(bad, name, "left_anti").drop(name)

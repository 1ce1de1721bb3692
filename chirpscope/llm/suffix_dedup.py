"""Removal of long repeated byte strings, by a difference cover and fingerprints sorted in
blocks.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.  Nothing
crosses documents; strings are judged on the input.

* **Cover sample.**  Positions whose residue modulo the period v lies in a perfect difference
  set D are sampled.  For any two positions some shift below v puts both on the sample, so two
  equal strings of ``length`` bytes always hold equal sampled strings of length - v + 1 bytes at
  the same shift.  Fingerprints of the sampled strings that occur twice therefore tell which
  positions can take part in a repeat at all.  The sample is a prefilter: no ranks are computed.
* **Blockwise.**  Fingerprints are dealt into buckets of about ``BUCKET`` entries by their
  leading bits and each bucket is sorted by itself, in one task and bounded memory.  First
  the cover sample is sorted, then the fingerprints of all ``length`` bytes at the positions that
  the sample left in question.  The reply to each shard is one bit per entry it sent.
* **Keys** are 64-bit fingerprints: only equality matters here, not alphabetical order; no suffix
  is sorted as a suffix, and ties are settled without comparing bytes.  Two
  given different strings agree with a probability of about 2**-64; the cover's keys are cut to
  16 bits more than the number of samples needs, which can only leave a few more suffixes tied.

A *shard* is some megabytes of whole documents.  It sends each distinct key once, with a flag if
it occurs again in the shard, so a passage repeated in a third of all documents is one entry a
shard.  Equal documents are found first (sha256) and only the first of them is sorted; equal
documents of ``length`` bytes or more go altogether.  Shards are stored once as a table bucketed
by shard, so later joins move only the bits.

Cases: null text is empty; texts shorter than ``length`` keep every byte; rows with equal ids or
equal rows are documents of their own (and repeat each other); other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpscope.llm import common as U
from chirpscope.session import scratch_path

LENGTH = 200
#: Entries of a bucket.
BUCKET = 1 << 20
#: Perfect difference sets: every residue is a difference of two members.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52),
          133: (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)}

SHARD = "shard long, doc_ids array<long>, lens array<long>, digests binary, text binary"
ENTRIES = "bucket long, shard long, keys binary"


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """The period (at most two thirds of the length) and the residues sampled."""
    v = max((k for k in COVERS if 3 * k <= 2 * length), default=min(COVERS))
    if v > length:
        raise ValueError(f"length must be at least {min(COVERS)}")
    flags = np.zeros(v, bool)
    flags[list(COVERS[v])] = True
    return v, flags


# --- sorted keys as bytes ------------------------------------------------------------------


def pack_keys(keys: np.ndarray, again: np.ndarray) -> bytes:
    """Sorted distinct keys: the first in 8 bytes, then steps as variable-length numbers; the
    lowest bit of each says if it occurs again."""
    step = np.empty(len(keys), np.uint64)
    step[0] = 0
    step[1:] = keys[1:] - keys[:-1]
    step = (step << np.uint64(1)) | again.astype(np.uint64)
    size = np.ones(len(step), np.int64)
    for k in range(1, 10):
        size += step >= (np.uint64(1) << np.uint64(7 * k))
    end = np.cumsum(size)
    begin = end - size
    out = np.zeros(int(end[-1]), np.uint8)
    live = np.arange(len(step))
    k = 0
    while len(live):
        more = size[live] > k + 1
        out[begin[live] + k] = ((step[live] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | (more.astype(np.uint8) << 7)
        live = live[more]
        k += 1
    return keys[:1].astype("<u8").tobytes() + out.tobytes()


def unpack_keys(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    first = np.frombuffer(raw, "<u8", 1)[0]
    b = np.frombuffer(raw, np.uint8, offset=8)
    last = np.flatnonzero(b < 128)
    begin = np.concatenate([[0], last[:-1] + 1])
    size = last - begin + 1
    step = np.zeros(len(last), np.uint64)
    live = np.arange(len(last))
    k = 0
    while len(live):
        step[live] |= (b[begin[live] + k] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
        live = live[size[live] > k + 1]
        k += 1
    return first + np.cumsum(step >> np.uint64(1), dtype=np.uint64), (step & np.uint64(1)).astype(bool)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and which of them occur again."""
    s = np.sort(keys)
    if not len(s):
        return s, np.zeros(0, bool)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[first], np.diff(np.append(first, len(s))) > 1


def bucket_of(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Equal ranges of the key space."""
    top = keys >> np.uint64(max(0, bits - 32)) if bits >= 32 else keys << np.uint64(32 - bits)
    return ((top * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def entries(shard: int, keys: np.ndarray, buckets: int, bits: int) -> pa.RecordBatch:
    k, again = distinct(keys)
    b = bucket_of(k, buckets, bits)
    cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(b))
    return pa.RecordBatch.from_pydict({
        "bucket": b[cut], "shard": np.full(len(cut), shard, np.int64),
        "keys": pa.array([pack_keys(k[x:y], again[x:y]) for x, y in zip(cut, ends)], pa.binary())})


def sort_buckets(sent: DataFrame) -> DataFrame:
    """(shard, bits): for each shard, bit by bit and bucket by bucket, whether the entry occurs
    elsewhere too."""
    def one(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        parts = [unpack_keys(r) for r in t["keys"].to_pylist()]
        keys, again = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(keys, kind="stable")
        s = keys[order]
        same = s[1:] == s[:-1]
        hit = np.zeros(len(s), bool)
        hit[1:] |= same
        hit[:-1] |= same
        again[order] |= hit
        ends = np.cumsum([len(p[0]) for p in parts])
        return pa.table({"shard": t["shard"], "bucket": t["bucket"],
                         "bits": pa.array([np.packbits(again[e - len(p[0]):e]).tobytes() for e, p in zip(ends, parts)], pa.binary())})

    back = sent.groupBy("bucket").applyInArrow(one, "shard long, bucket long, bits binary")
    return back.groupBy("shard").agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "bits"))), lambda x: x["bits"]).alias("bits"))


def repeated(keys: np.ndarray, bits: list[bytes], buckets: int, width: int) -> np.ndarray:
    """Which of a shard's keys (unsorted, as they were sent) occur elsewhere."""
    k, _ = distinct(keys)
    if not len(k):
        return np.zeros(0, bool)
    b = bucket_of(k, buckets, width)
    count = np.diff(np.append(np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])), len(b)))
    flags = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=int(n)) for x, n in zip(bits, count)]).astype(bool)
    return flags[np.searchsorted(k, keys)]


# --- one shard ---------------------------------------------------------------------------------


class Shard:
    def __init__(self, r: dict, length: int):
        self.id, self.length = r["shard"], length
        self.data = np.frombuffer(r["text"], np.uint8)
        self.lens = np.array(r["lens"], np.int64)
        self.off = np.concatenate([[0], np.cumsum(self.lens)])
        self.doc_ids = r["doc_ids"]
        self.role = np.zeros(len(self.lens), np.int8)                # 1: has copies, 2: is a copy
        if r.get("copies") is not None:
            for nth, role in r["copies"]:
                self.role[nth] = role
        self.live = (self.lens >= length) & (self.role != 2)
        self.prints = U.Prints(self.data)

    def _places(self, spare: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the ranges of positions with ``spare`` bytes from there on."""
        return self.off[:-1][self.live], self.lens[self.live] - spare + 1

    def sample(self, flags: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        v = len(flags)
        width = self.length - v + 1
        start, n = self._places(width)
        at = U.spread(start, n)
        at = at[flags[(at - np.repeat(start, n)) % v]]
        return at, self.prints.of(at, at + width) >> np.uint64(64 - bits)

    def tied(self, at: np.ndarray, v: int) -> np.ndarray:
        """Starts of strings that hold a repeated sample at a shift below v."""
        doc = np.searchsorted(self.off, at, "right") - 1
        first, last = np.maximum(at - v + 1, self.off[doc]), np.minimum(at, self.off[doc + 1] - self.length)
        mark = np.zeros(len(self.data) + 1, np.int32)
        fine = last >= first
        np.add.at(mark, first[fine], 1)
        np.add.at(mark, last[fine] + 1, -1)
        return np.flatnonzero(np.cumsum(mark[:-1]) > 0)

    def result(self, starts: np.ndarray) -> pa.RecordBatch:
        mark = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(mark, starts, 1)
        np.add.at(mark, starts + self.length, -1)
        gone = np.cumsum(mark[:-1]) > 0
        removed, spans, sha = [], [], []
        for k, (a, b) in enumerate(zip(self.off[:-1], self.off[1:])):
            g = gone[a:b]
            if self.role[k] and b - a >= self.length:
                g = np.ones(b - a, bool)
            removed.append(int(g.sum()))
            spans.append(int((g[1:] & ~g[:-1]).sum() + (g[0] if b > a else 0)))
            sha.append(hashlib.sha256((self.data[a:b][~g] if removed[-1] else self.data[a:b]).tobytes()).hexdigest())
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(self.doc_ids, pa.int64()), "n_bytes": self.lens, "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})


# --- on Spark --------------------------------------------------------------------------------------


def store_shards(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents as shards, in a table bucketed by shard."""
    spark = docs.sparkSession
    U.small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for seq, b in enumerate(U.bulk(batches, "text")):
            data, off = U.text_bytes(b.column("text"))
            raw = data.tobytes()
            yield pa.RecordBatch.from_pydict({
                "shard": [base + seq], "doc_ids": pa.array([b.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                "lens": pa.array([np.diff(off)], pa.list_(pa.int64())),
                "digests": pa.array([b"".join(hashlib.sha256(raw[x:y]).digest() for x, y in zip(off[:-1], off[1:]))], pa.binary()),
                "text": pa.array([raw], pa.binary())})

    name = f"llm_shards_{uuid.uuid4().hex}"
    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SHARD)
     .write.option("path", scratch_path(spark, "llm-shards")).option("compression", "zstd")
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard").saveAsTable(name))
    return spark.table(name)


def copies(shards: DataFrame, length: int) -> DataFrame:
    """(shard, copies): which documents of a shard equal others; one of them is the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                n = len(r["lens"])
                long = [k for k in range(n) if r["lens"][k] >= length]
                yield pa.RecordBatch.from_pydict({
                    "digest": pa.array([r["digests"][32 * k:32 * k + 32] for k in long], pa.binary()),
                    "shard": pa.array([r["shard"]] * len(long), pa.int64()), "nth": pa.array(long, pa.int32())})

    rows = U.stored(shards.select("shard", "lens", "digests").mapInArrow(run, "digest binary, shard long, nth int"), "digests")
    many = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("shard", "nth")).alias("first")).filter("n > 1")
    found = rows.join(many, "digest").select("shard", F.struct("nth", F.when(
        F.struct("shard", "nth") == F.col("first"), 1).otherwise(2).cast("int").alias("role")).alias("c"))
    return U.stored(found.groupBy("shard").agg(F.collect_list("c").alias("copies")), "copies")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   bucket: int = BUCKET) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    spark = docs.sparkSession
    v, flags = cover_for(length)
    shards = store_shards(docs, id_col, text_col)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    shards = shards.drop("digests").join(copies(shards, length), "shard", "left")
    total = shards.agg(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x))).head()[0] or 0
    samples = total * int(flags.sum()) // v + 1
    width = min(64, max(32, int(np.ceil(np.log2(samples))) + 16))
    first_buckets = max(4, samples // bucket)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Shard, dict]]:
        for b in batches:
            for k in range(b.num_rows):
                r = {c: b.column(c)[k].as_py() for c in b.schema.names if c not in ("copies", "text")}
                r["copies"] = [(x["nth"], x["role"]) for x in b.column("copies")[k].as_py() or []]
                r["text"] = b.column("text")[k].as_buffer() if b.column("text")[k].is_valid else b""
                yield Shard(r, length), r

    def send_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, _ in each(batches):
            yield entries(s.id, s.sample(flags, width)[1], first_buckets, width)

    def ties(s: Shard, r: dict) -> np.ndarray:
        at, keys = s.sample(flags, width)
        return s.tied(at[repeated(keys, r["cover"] or [], first_buckets, width)], v)

    cover = U.stored(sort_buckets(shards.mapInArrow(send_sample, ENTRIES)), "cover-bits").withColumnRenamed("bits", "cover")
    tied = shards.join(cover, "shard", "left")
    marked = cover.agg(F.sum(F.aggregate("cover", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x)))).head()[0] or 0
    second_buckets = max(4, int(8 * marked * v / flags.sum() / 4) // bucket)

    def send_tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, r in each(batches):
            at = ties(s, r)
            yield entries(s.id, s.prints.of(at, at + length), second_buckets, 64)

    whole = U.stored(sort_buckets(tied.mapInArrow(send_tied, ENTRIES)), "string-bits").withColumnRenamed("bits", "strings")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, r in each(batches):
            at = ties(s, r)
            yield s.result(at[repeated(s.prints.of(at, at + length), r["strings"] or [], second_buckets, 64)])

    return tied.join(whole, "shard", "left").mapInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")

"""Token-ID output: byte-level BPE ids in patched frame-of-reference (PFOR) blocks.

Documents are range-partitioned and sorted by id; each task tokenises its run and writes
*segments*.  A segment is a complete little file (the ``file`` column of the written table):

    magic ``PFR1`` | u32 documents | u64 ids | u32 block size | u32 blocks
    u8 id-is-null and i64 id of each document | u64 ids of each document
    u64 start of each block in the payload (the index), plus its end
    payload, per block: u32 minimum, u8 width, u16 exceptions | packed low bits
                        | u8 exception positions | u32 exception values

A block subtracts its minimum and packs at the width that holds a percentile of the differences
(of ``PERCENTILES`` the one that makes the block smallest); larger ones are exceptions, stored
whole in a list that patches the block.  The index gives random access: ``read_range`` decodes
only the blocks that it needs.

Segments travel as rows of a Parquet table, so Spark's commit protocol makes a lost or repeated
task harmless and any file system that Spark can write will do.

Cases: null text is empty (one end id); null ids come first; repeated ids or rows keep one entry
each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpscope.llm import common as U
from chirpscope.session import scratch_path

BLOCK = 128
PERCENTILES = (0.75, 0.95, 1.0)
#: Known pieces kept in a worker before the cache starts anew; bounds memory, never changes ids.
CACHE_PIECES = 500_000
#: Bytes of text that make a segment.
SEGMENT_BYTES = 8 << 20
MAGIC = b"PFR1"
SEGMENTS = "part int, seq int, start long, n_docs long, n_tokens long, file binary"



def byte_bpe() -> str:
    """The public byte-level BPE vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# --- PFOR ----------------------------------------------------------------------------


def pack(ids: np.ndarray, block: int = BLOCK, percentiles: tuple[float, ...] = PERCENTILES) -> tuple[bytes, np.ndarray]:
    """Payload and block starts (with the end)."""
    n = len(ids)
    blocks = -(-n // block)
    if not blocks:
        return b"", np.zeros(1, np.uint64)
    v = np.full(blocks * block, ids[-1], np.int64)
    v[:n] = ids
    v = v.reshape(blocks, block)
    low = v.min(axis=1)
    d = v - low[:, None]
    at = [max(0, int(np.ceil(p * block)) - 1) for p in percentiles]
    widths = np.ceil(np.log2(np.partition(d, at, axis=1)[:, at] + 1)).astype(np.int64)
    cost = np.stack([w * block // 8 + 5 * (d >> w[:, None] > 0).sum(axis=1) for w in widths.T], axis=1)
    width = widths[np.arange(blocks), cost.argmin(axis=1)]
    out = d >> width[:, None] > 0
    n_exc = out.sum(axis=1)
    body = width * block // 8 + (width * block % 8 > 0)
    size = 7 + body + 5 * n_exc
    starts = np.zeros(blocks + 1, np.uint64)
    starts[1:] = np.cumsum(size)
    payload = np.zeros(int(starts[-1]), np.uint8)
    s = starts[:-1].astype(np.int64)
    head = np.concatenate([low.astype("<u4").view(np.uint8).reshape(-1, 4),
                           width.astype(np.uint8)[:, None],
                           n_exc.astype("<u2").view(np.uint8).reshape(-1, 2)], axis=1)
    payload[s[:, None] + np.arange(7)] = head
    for w in np.unique(width):
        if w:
            k = np.flatnonzero(width == w)
            cell = "<u2" if w <= 16 else "<u4"
            raw = np.ascontiguousarray(d[k] & ((1 << int(w)) - 1)).astype(cell).view(np.uint8).reshape(len(k) * block, -1)
            bits = np.unpackbits(raw, axis=1, count=int(w), bitorder="little")
            packed = np.packbits(bits.reshape(len(k), -1), axis=1, bitorder="little")
            payload[(s[k] + 7)[:, None] + np.arange(packed.shape[1])] = packed
    row, col = np.nonzero(out)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_exc) - n_exc, n_exc)
    base = s[row] + 7 + body[row]
    payload[base + nth] = col
    payload[(base + n_exc[row] + 4 * nth)[:, None] + np.arange(4)] = \
        d[row, col].astype("<u4").view(np.uint8).reshape(-1, 4)
    return payload.tobytes(), starts


def unpack(payload: np.ndarray, starts: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The first ``n`` ids of the blocks that begin at ``starts`` (without the end)."""
    s = starts.astype(np.int64)
    head = payload[s[:, None] + np.arange(7)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0].astype(np.int64)
    width = head[:, 4].astype(np.int64)
    n_exc = np.ascontiguousarray(head[:, 5:]).view("<u2")[:, 0].astype(np.int64)
    body = width * block // 8 + (width * block % 8 > 0)
    d = np.zeros((len(s), block), np.int64)
    for w in np.unique(width):
        if w:
            k = np.flatnonzero(width == w)
            raw = payload[(s[k] + 7)[:, None] + np.arange(-(-int(w) * block // 8))]
            cell = np.dtype("<u2" if w <= 16 else "<u4")
            bits = np.unpackbits(raw, axis=1, count=int(w) * block, bitorder="little").reshape(len(k) * block, w)
            full = np.zeros((len(bits), 8 * cell.itemsize), np.uint8)
            full[:, :w] = bits
            d[k] = np.packbits(full, axis=1, bitorder="little").view(cell).reshape(len(k), block)
    row = np.repeat(np.arange(len(s)), n_exc)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_exc) - n_exc, n_exc)
    base = s[row] + 7 + body[row]
    col = payload[base + nth]
    d[row, col] = payload[(base + n_exc[row] + 4 * nth)[:, None] + np.arange(4)].view("<u4")[:, 0]
    return (d + low[:, None]).reshape(-1)[:n]


def write_segment(doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> bytes:
    payload, starts = pack(ids)
    known = pc.fill_null(doc_ids, 0).to_numpy(zero_copy_only=False)
    return b"".join([MAGIC, struct.pack("<IQII", len(counts), len(ids), BLOCK, len(starts) - 1),
                     pc.is_null(doc_ids).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                     known.astype("<i8").tobytes(), counts.astype("<u8").tobytes(),
                     starts.astype("<u8").tobytes(), payload])


class Segment:
    """A written segment; arrays are views of the bytes."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token segment")
        docs, self.n, self.block, blocks = struct.unpack_from("<IQII", raw, 4)
        at = 24
        missing = np.frombuffer(raw, np.uint8, docs, at).astype(bool)
        at += docs
        self.doc_ids = pa.array(np.frombuffer(raw, "<i8", docs, at).astype(np.int64), mask=missing)
        at += 8 * docs
        self.counts = np.frombuffer(raw, "<u8", docs, at).astype(np.int64)
        at += 8 * docs
        self.starts = np.frombuffer(raw, "<u8", blocks + 1, at)
        self.payload = np.frombuffer(raw, np.uint8, offset=at + 8 * (blocks + 1))

    def read_range(self, first: int, last: int) -> np.ndarray:
        """Ids first .. last-1, from only the blocks that hold them."""
        last = min(last, self.n)
        if first >= last:
            return np.zeros(0, np.int64)
        a, b = first // self.block, -(-last // self.block)
        got = unpack(self.payload, self.starts[a:b], (b - a) * self.block, self.block)
        return got[first - a * self.block:last - a * self.block]


# --- tokens ---------------------------------------------------------------------------

_ASCII = U.byte_class(range(0x21, 0x7F))
_LETTER = U.byte_class([*range(65, 91), *range(97, 123)])
_PUNCT = U.byte_class(b'.,;:!?|*#&%$"()[]{}=+-_/<>@')
#: Bytes that may begin white space of more than one byte, control bytes and white space.
_UNSURE = U.byte_class([*range(0x21), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3])


def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Piece starts (with the end) at which the tokenizer's own splitting pattern always cuts,
    whatever stands around: before a lone space between printing characters, around a lone
    newline, and between an ASCII letter and ASCII punctuation other than the apostrophe."""
    n = len(data)
    at = np.zeros(n + 1, bool)
    at[off] = True
    if n > 3:
        sp = np.flatnonzero(data[2:-1] == 0x20) + 2
        one, two = data[sp - 1], data[sp - 2]
        whole = np.where(one < 0x80, _ASCII[one], (two >= 0xC3) & (two <= 0xDF))
        at[sp[whole & ~_UNSURE[data[sp + 1]]]] = True
        pp = np.flatnonzero(_PUNCT[data[1:]]) + 1
        at[pp[_LETTER[data[pp - 1]]]] = True
        nl = np.flatnonzero(data[1:-1] == 10) + 1
        nl = nl[_ASCII[data[nl - 1]] & ~_UNSURE[data[nl + 1]]]
        at[nl] = at[nl + 1] = True
    return np.flatnonzero(at)


class Encoder:
    """Encodes texts with the ``tokenizers`` library.  Texts are cut where the tokenizer cuts
    anyway, each distinct piece is encoded once per worker, and ids are put together again."""

    def __init__(self, path: str, end_id: int = 0):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.newline = self.tok.encode("\n", add_special_tokens=False).ids
        self.end_id = end_id
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool = np.array([self.end_id], np.int32)      # piece 0 is the end of a document
        self.lens = np.ones(1, np.int64)

    def _encode(self, pieces: list[bytes]) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
        """The pieces in another order, the number of ids of each, and all their ids in that order.
        Plain pieces are joined by newlines into one call; the others go one by one."""
        data = np.frombuffer(b"".join(pieces) + b"..", np.uint8)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        end = np.cumsum(size)
        begin = end - size
        head = np.minimum(begin + (data[begin] == 0x20), end)
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        closed = _ASCII[data[end - 1]] | ((end - head > 1) & (data[end - 2] >= 0xC3) & (data[end - 2] <= 0xDF))
        fine = (head < end) & (lines[end] == lines[begin]) & ~_UNSURE[data[head]] & closed
        plain, odd = np.flatnonzero(fine).tolist(), np.flatnonzero(~fine).tolist()
        order, counts, ids = [], [], []
        for j in range(0, len(plain), 512):
            g = plain[j:j + 512]
            got = np.array(self.tok.encode_batch_fast([b"\n".join([pieces[k] for k in g]).decode()], add_special_tokens=False)[0].ids, np.int32)
            sep = np.flatnonzero(got == self.newline[0])
            if len(self.newline) != 1 or len(sep) != len(g) - 1:
                odd += g
                continue
            order += g
            counts.append(np.diff(np.concatenate([[-1], sep, [len(got)]])) - 1)
            ids.append(np.delete(got, sep))
        for e in self.tok.encode_batch_fast([pieces[k].decode() for k in odd], add_special_tokens=False):
            counts.append(np.array([len(e.ids)], np.int64))
            ids.append(np.array(e.ids, np.int32))
        order += odd
        return [pieces[k] for k in order], np.concatenate(counts), ids

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by the end id, and the number of ids of each."""
        data, off = U.text_bytes(texts)
        at = cuts(data, off)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at) - 1,
                                       [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()) if len(coded.dictionary) else pa.array([], pa.binary())
        if len(self.known) > CACHE_PIECES:
            self._clear()
        names = distinct.to_pylist()
        place = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        fresh = np.flatnonzero(place < 0)
        if len(fresh):
            new, counts, got = self._encode([names[k] for k in fresh.tolist()])
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            place[fresh] = [self.known[names[k]] for k in fresh.tolist()]
            self.lens = np.concatenate([self.lens, counts])
            self.pool = np.concatenate([self.pool, *got])
        code = place[coded.indices.to_numpy()] + 1 if len(at) > 1 else np.zeros(0, np.int64)
        ends = np.searchsorted(at[:-1], off[1:])              # pieces before the end of each text
        code = np.insert(code, ends, 0)
        begin = np.cumsum(self.lens) - self.lens
        lens = self.lens[code]
        ids = self.pool[U.spread(begin[code], lens)]
        total = np.concatenate([[0], np.cumsum(lens)])
        stop = total[ends + np.arange(1, len(ends) + 1)]
        return ids, np.diff(np.concatenate([[0], stop]))


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """The encoder of this worker, with the pieces that it knows from earlier tasks."""
    U.release()
    if (path, end_id) not in _encoders:
        _encoders.clear()
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


# --- the operator ----------------------------------------------------------------------


def write_tokens(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 0) -> None:
    """Tokenise ``docs`` and write its segments to the table at ``path``, in ascending id order
    (``part``, then ``seq``).  Rows with equal ids are spread by their place in the input, so
    one id may hold any share of the rows."""
    spark = docs.sparkSession
    U.small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, end_id)
        part, start = TaskContext.get().partitionId(), 0
        for seq, b in enumerate(U.bulk(batches, "text", SEGMENT_BYTES)):
            ids, counts = encode(b.column("text"))
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "start": [start],
                "n_docs": [len(counts)], "n_tokens": [len(ids)],
                "file": pa.array([write_segment(b.column("doc_id"), counts, ids)], pa.binary())})
            start += len(ids)

    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                 F.monotonically_increasing_id().alias("_nth"))
     .repartitionByRange(parts, "doc_id", "_nth").sortWithinPartitions("doc_id", "_nth")
     .select("doc_id", "text").mapInArrow(segments, SEGMENTS)
     .write.option("compression", "none").parquet(path))


def read_tokens(spark, path: str, digest: bool = True) -> DataFrame:
    """One row per document from the written segments: doc_id, start, n_tokens, and either
    ids_crc32 or the ids themselves.  The driver sees one total per written partition only."""
    table = spark.read.schema(SEGMENTS).parquet(path)
    begin, total = {}, 0
    for r in table.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        begin[r["part"]], total = total, total + r["n"]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                seg = Segment(r["file"])
                ids = seg.read_range(0, seg.n).astype("<u4")
                ends = np.cumsum(seg.counts)
                starts = ends - seg.counts
                out = {"doc_id": seg.doc_ids, "start": starts + r["start"] + begin[r["part"]], "n_tokens": seg.counts}
                if digest:
                    out["ids_crc32"] = pa.array([zlib.crc32(ids[x:y]) for x, y in zip(starts, ends)], pa.int64())
                else:
                    out["ids"] = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids.astype(np.int32))
                yield pa.RecordBatch.from_pydict(out)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    return table.select("part", "start", "file").mapInArrow(
        documents, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>"))


def token_output(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 0, path: str | None = None) -> DataFrame:
    """Write the token files, read them back, return their digests."""
    path = path or scratch_path(docs.sparkSession, "llm-tokens")
    write_tokens(docs, tokenizer, path, id_col, text_col, end_id)
    return read_tokens(docs.sparkSession, path)

"""Quoted CSV read in parallel, embedded newlines and all.

A quoted field may hold newlines, so a byte block of a file does not tell where its records start:
a line break is a record's end only where the number of quotes before it is even.  The reader works
in two passes over the blocks into which Spark's text source cuts a file:

1. each block counts its quotes; the parities, combined in order of the blocks (a prefix XOR), say
   for every block whether it begins inside a quoted field;
2. each block, knowing that, cuts its own lines into records.  What it cannot finish - the lines
   before its first record start, and an open record at its end - goes on as a *fragment*.

Fragments (at most two a block) are stitched in block order, and all records are parsed with the CSV
parser of Spark, each as a text of its own.  One large file is so read by as many tasks as it has
blocks.  The driver sees one small row for each block that begins inside quotes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
#: A finished record, the head of a block that ends a record begun before it, an unfinished record,
#: and a block that lies within one record.
WHOLE, HEAD, OPEN, INSIDE = 0, 1, 2, 3
PIECES = "file string, block long, kind int, first boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, block: the lines of the text source in file order, with the block that each came from."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def odd_blocks(lines: DataFrame) -> tuple[dict[str, set[int]], list[str]]:
    """Blocks that begin inside a quoted field, by file, and the files that end inside one."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(QUOTE), F.lit("")))
    blocks = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block")
    seen = blocks.withColumn("upto", F.sum("odd").over(before) % 2)
    seen = seen.withColumn("inside", (F.col("upto") != F.col("odd")))
    last = F.row_number().over(Window.partitionBy("file").orderBy(F.desc("block"))) == 1
    begins: dict[str, set[int]] = {}
    unclosed = []
    for r in seen.withColumn("unclosed", last & (F.col("upto") == 1)).filter("inside or unclosed").toLocalIterator():
        if r["inside"]:
            begins.setdefault(r["file"], set()).add(r["block"])
        if r["unclosed"]:
            unclosed.append(r["file"])
    return begins, unclosed


def _cut(lines: pa.Array, inside: bool) -> tuple[np.ndarray, bool]:
    """For each line, whether it starts a record; and whether the last line leaves a quote open."""
    n = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False).astype(np.int64)
    after = (np.cumsum(n) + inside) % 2
    before = np.empty(len(after), np.int64)
    before[0], before[1:] = inside, after[:-1]
    return before == 0, bool(after[-1])


class _Block:
    """The records of one block, line by line."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.inside = file, block, inside
        self.held: list[str] = []          # lines of a record that may go on
        self.started = False               # whether that record began in this block
        self.fresh = block == 0            # the file's first record is still to come

    def take(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        starts, self.inside = _cut(lines, self.inside)
        texts, at = lines.to_pylist(), np.flatnonzero(starts).tolist()
        if not at:
            self.held += texts
            return
        self.held += texts[:at[0]]
        done = []
        if self.held:
            if self.started:
                done.append("\n".join(self.held))
            else:
                yield self._rows(HEAD, ["\n".join(self.held)])
        done += [texts[x] if y == x + 1 else "\n".join(texts[x:y]) for x, y in zip(at, at[1:])]
        self.held, self.started = texts[at[-1]:], True
        if done:
            yield self._rows(WHOLE, done)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            kind = (OPEN if self.inside else WHOLE) if self.started else (INSIDE if self.inside else HEAD)
            yield self._rows(kind, ["\n".join(self.held)])

    def _rows(self, kind: int, texts: list[str]) -> pa.RecordBatch:
        n = len(texts)
        first = np.zeros(n, bool)
        if kind in (WHOLE, OPEN):
            first[0], self.fresh = self.fresh, False
        return pa.RecordBatch.from_pydict({
            "file": pa.array([self.file] * n, pa.string()), "block": pa.array([self.block] * n, pa.int64()),
            "kind": pa.array([kind] * n, pa.int32()), "first": pa.array(first), "record": pa.array(texts, pa.string())})


def pieces(lines: DataFrame, begins: dict[str, set[int]]) -> DataFrame:
    """Records and fragments of every block (``PIECES``); ``first`` marks the first record of a file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Block | None = None
        for b in batches:
            if not b.num_rows:
                continue
            file, block = b.column("file").dictionary_encode(), b.column("block").to_numpy()
            code = file.indices.to_numpy()
            edge = np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), b.num_rows]):
                name, at = file.dictionary[int(code[s])].as_py(), int(block[s])
                if now is None or (now.file, now.block) != (name, at):
                    if now is not None:
                        yield from now.close()
                    now = _Block(name, at, at in begins.get(name, ()))
                yield from now.take(b.column("value").slice(s, e - s))
        if now is not None:
            yield from now.close()

    return lines.mapInArrow(run, PIECES)


def records(spark: SparkSession, path: str) -> DataFrame:
    """record, first: every record of the files under ``path`` as text (with its newlines), in no
    particular order.  Raises if a quoted field is still open at the end of a file."""
    lines = _lines(spark, path)
    begins, unclosed = odd_blocks(lines)
    if unclosed:
        raise ValueError(f"a quoted field is not closed in {unclosed[0]}")
    every = pieces(lines, begins)
    order = Window.partitionBy("file").orderBy("block", "at")
    # within a block the head of an older record comes before its own open one
    parts = every.filter(F.col("kind") != WHOLE).withColumn("at", F.when(F.col("kind") == OPEN, 1).otherwise(0))
    parts = parts.withColumn("nth", F.sum(F.when(F.col("kind") == OPEN, 1).otherwise(0)).over(order))
    stitched = parts.groupBy("file", "nth").agg(F.array_sort(F.collect_list(F.struct("block", "at", "record"))).alias("all"),
                                                F.max("first").alias("first"))
    stitched = stitched.select(F.array_join(F.transform("all", lambda x: x["record"]), "\n").alias("record"), "first")
    both = every.filter(F.col("kind") == WHOLE).select("record", "first").unionByName(stitched)
    return both.withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The files under ``path`` parsed by ``schema``.  With ``header`` the first record of each file must
    name the schema's columns.  Blank lines are skipped, as Spark's reader does."""
    rows = records(spark, path).filter(F.col("record") != "")
    wanted = {k: v for k, v in options.items() if k not in ("header", "multiLine", "encoding")}
    if options.get("header", "false").lower() == "true":
        names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema.fields))])
        head = F.from_csv("record", names.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                          {k: v for k, v in wanted.items() if "Format" not in k})
        got = F.concat_ws(",", *[head[f"c{i}"] for i in range(len(schema.fields))])
        other = F.raise_error(F.concat(F.lit("header differs from the schema: "), F.col("record"))).cast("boolean")
        rows = rows.filter(F.when(F.col("first"), F.when(got == ",".join(schema.names), F.lit(False)).otherwise(other)).otherwise(True))
    text = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select(F.from_csv("record", text, wanted).alias("r")).select("r.*")

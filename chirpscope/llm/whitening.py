"""Embedding whitening with MLlib's BlockMatrix.

Integer vectors ``x = floor(256 * c)`` are stored once; the fit list holds every distinct one a
single time, and its sums and its number come from one aggregation.  Centred vectors are numbered
without gaps (rows of each stored partition, counted, give the offsets) and grouped by number into
blocks of ``BLOCK`` rows.  The scatter matrix is the transposed
block matrix times itself, cut along the shared dimension into tasks of ``MID_BLOCKS`` blocks; only
that matrix of dim x dim numbers reaches the driver, where ``eigh`` factors it.  All rows are then
projected by one more block multiplication.

Cases: rows whose vector is null, empty, or holds null or non-finite entries are left out, and so are
rows of another length than the commonest (the shortest of equally common ones) and those with an
entry of 2**53 and more after scaling.  Equal vectors count once in the fit and keep a result row
each; a null id is kept.  A component whose eigenvalue is zero (to rounding) has a null ``whitened``
and no part in ``identity_error``.  ``deviation`` is null where it would pass 64 bits.  Other columns
are ignored; an empty table, or one without a usable row, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpscope.llm import common as U

SCALE = 256
COMPONENTS = 4
#: Rows of a block, and blocks that one task multiplies.
BLOCK = 512
MID_BLOCKS = 16
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def scaled(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, x: the usable rows as integer vectors of one length (stored)."""
    v = F.transform(F.col(vec_col), lambda c: F.floor(c.cast("double") * SCALE))
    fine = F.forall(F.col(vec_col), lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                    & (F.abs(c.cast("double")) < 2.0 ** 53 / SCALE))
    rows = U.stored(vectors.filter(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & fine)
                    .select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<long>").alias("x")), "scaled")
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").head()
    return rows if common is None else rows.filter(F.size("x") == common["dim"])


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` stored with ``index`` = 0, 1, 2, ... and no gap; one count per partition reaches the driver."""
    placed = U.stored(rows.withColumn("place", F.monotonically_increasing_id()), name)
    part = F.shiftright("place", 33)
    offsets, total = [], 0
    for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("place").alias("first")).orderBy("part").collect():
        offsets.append((r["part"], total - r["first"]))
        total += r["n"]
    if not offsets:
        return placed.withColumnRenamed("place", "index")
    shift = rows.sparkSession.createDataFrame(offsets, "part long, shift long")
    return (placed.withColumn("part", part).join(F.broadcast(shift), "part")
            .withColumn("index", F.col("place") + F.col("shift")).drop("part", "place", "shift"))


def block_matrix(rows: DataFrame, mean: np.ndarray) -> BlockMatrix:
    """The centred rows (``index``, ``x``) as distributed blocks; zero rows fill up the last one."""
    dim, block = len(mean), BLOCK

    def pack(group: pa.Table) -> pa.Table:
        index = group.column("index").to_numpy()
        x = group.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(index), dim)
        out = np.zeros((block, dim))
        out[index % block] = x - mean
        return pa.table({"block": index[:1] // block, "data": pa.array([out.tobytes(order="F")], pa.binary())})

    def placed(r) -> tuple:
        return (r["block"], 0), DenseMatrix(block, dim, np.frombuffer(r["data"]))

    packed = rows.groupBy(F.floor(F.col("index") / block).alias("b")).applyInArrow(pack, "block long, data binary")
    return BlockMatrix(packed.rdd.map(placed), block, dim)


def times(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """a * b; ``splits`` cuts the shared dimension, so that one result block is the work of many tasks."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transposed matrix times itself."""
    splits = max(1, -(-matrix.numRowBlocks // MID_BLOCKS))
    return times(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()


def local_block(matrix: BlockMatrix, values: np.ndarray, spark) -> BlockMatrix:
    """A small matrix of one block."""
    dense = Matrices.dense(*values.shape, values.ravel(order="F"))
    return BlockMatrix(spark.sparkContext.parallelize([((0, 0), dense)], 1), *values.shape)


def principal(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns)."""
    e, v = np.linalg.eigh((covariance + covariance.T) / 2)
    return e[::-1][:components], v[:, ::-1][:, :components]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    rows = scaled(vectors, id_col, vec_col)
    fit = numbered(rows.select("x").distinct(), "fit")
    first = fit.select(F.size("x").alias("dim")).head()
    if first is None:
        return spark.createDataFrame([], SCHEMA)
    dim = first["dim"]
    totals = fit.agg(F.count("*"), *[F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")) for i in range(dim)]).head()
    n, sums = totals[0], [int(t) for t in totals[1:]]
    mean = np.array([s / n for s in sums])

    matrix = block_matrix(fit, mean).persist(StorageLevel.MEMORY_AND_DISK)
    covariance = scatter(matrix) / n
    e, v = principal(covariance, components)
    trace = float(np.trace(covariance))
    some = e > max(trace, 0.0) * dim * np.finfo(float).eps
    w = np.where(some, v / np.sqrt(np.where(some, e, 1.0)), 0.0)
    k = int(some.sum())
    error = 0.0
    if k:
        own = scatter(times(matrix, local_block(matrix, w[:, :k], spark))) / n
        error = float(np.abs(own - np.eye(k)).max())
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)

    every = numbered(rows, "rows")
    projected = times(block_matrix(every, mean), local_block(matrix, w, spark)).toIndexedRowMatrix()
    values = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model)
    values = values.select(F.col("index").cast("long").alias("index"), vector_to_array("vector").alias("values"))
    explained = [float(x) / trace if trace > 0 else 0.0 for x in e]
    per = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.lit(explained[i]).alias("explained"), F.lit(bool(some[i])).alias("some"))
                    for i in range(len(e))])
    return (deviations(every, n, sums).join(values, "index")
            .select("vec_id", "deviation", "values", F.posexplode(per).alias("at", "c"))
            .select("vec_id", "c.component", F.lit(n).cast("long").alias("n"), "deviation",
                    F.when(F.col("c.some"), F.get("values", "at")).alias("whitened"), "c.explained",
                    F.lit(error).alias("identity_error")))


def deviations(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """vec_id, index, deviation: the sum over dimensions of (n * x - S) ** 2, exact."""
    far = max(map(abs, sums), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(sums))
            bound = n * int(np.abs(x).max()) + far
            if bound * bound * len(sums) < 2 ** 63:
                d = n * x - np.array(sums, np.int64)
                out = (d * d).sum(axis=1).tolist()
            else:
                out = [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]
            yield pa.RecordBatch.from_pydict({"vec_id": b.column("vec_id"), "index": b.column("index"),
                                              "deviation": pa.array([d if d < 2 ** 63 else None for d in out], pa.int64())})

    return rows.select("vec_id", "index", "x").mapInArrow(run, "vec_id long, index long, deviation long")

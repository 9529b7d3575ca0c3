"""Whitening of embeddings by MLlib's distributed block matrices.

Centred rows are cut into blocks, numbered, and indexed as a BlockMatrix; its transpose times itself is the
scatter, of which the driver takes the eigenvectors; multiplying the blocks by the whitening matrix projects
every row. A block is one row of a written table, with the ids of its vectors, so rows are never shuffled one
by one, and only whole blocks go to MLlib and back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from pagecat.llm.common import dropped, written
from pagecat.llm.vectors import finite, id_vector, stacked

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
# Rows of a block at least; tables of more than MOST_BLOCKS of them get taller blocks, up to TALLEST,
# as the driver plans a product from the places of all blocks.
BLOCK = 1024
MOST_BLOCKS = 1 << 16
TALLEST = 1 << 12
# Components beyond this after scaling stop the job.
LARGEST = 1 << 40
# Eigenvalues below this part of the largest are rounding errors of a dimension without spread.
FLAT = 1e-12


def kept(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, x: finite vectors that aren't empty, each component floor(scale * component) + shift."""
    rows = id_vector(embeddings, id_col, vector_col).where(finite(F.col("v")) & (F.size("v") > 0))
    whole = F.transform("v", lambda c: F.floor(c * float(scale)))
    beyond = F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling"))
    small = F.forall("x", lambda c: (c < LARGEST) & (c > -LARGEST))
    return rows.select("vec_id", whole.alias("x")).select("vec_id", F.when(small, F.transform("x", lambda c: c + shift)).otherwise(beyond).alias("x"))


def sums(rows: DataFrame, column: str, dims: int) -> list[int]:
    """Exact sum per place of an array column of integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = stacked(batch.column(0), dims).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(part)], ["d", "s"])

    parts = rows.select(column).mapInArrow(run, "d long, s long").groupBy("d")
    return [int(r["s"]) for r in sorted(parts.agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())]


def cut(rows: DataFrame, total: list[int], n: int, tall: int) -> DataFrame:
    """at, vec_id, deviation, rows: blocks of ``tall`` rows, filled up with zeros, in row order as 64-bit floats.

    A row holds (n * x - S) / n, its deviation is the sum of the squares of n * x - S. ``at`` numbers the
    blocks by partition.
    """
    dims = len(total)

    def block(ids: list, xs: list) -> pa.RecordBatch:
        x = np.concatenate(xs)
        fits = n * max(int(x.max()), -int(x.min())) < 1 << 62
        apart = x * n - np.array(total, np.int64) if fits else x.astype(object) * n - np.array(total, object)
        if fits and (apart.astype(np.float64) ** 2).sum(axis=1).max() < 2.0**62:
            deviation = (apart * apart).sum(axis=1).tolist()
        else:
            deviation = [d if d < 1 << 63 else None for d in (apart.astype(object) ** 2).sum(axis=1)]
        values = np.zeros((tall, dims), "<f8")
        values[: len(x)] = apart / n
        columns = [pa.array([ids], pa.list_(pa.int64())), pa.array([deviation], pa.list_(pa.int64())), pa.array([values.tobytes()])]
        return pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, xs = [], []
        for batch in batches:
            x, own = stacked(batch.column(1), dims), batch.column(0).to_pylist()
            while len(x):
                room = tall - len(ids)
                ids += own[:room]
                xs.append(x[:room])
                own, x = own[room:], x[room:]
                if len(ids) == tall:
                    yield block(ids, xs)
                    ids, xs = [], []
        if ids:
            yield block(ids, xs)

    out = rows.select("vec_id", "x").mapInArrow(run, "vec_id array<long>, deviation array<long>, rows binary")
    return out.select(F.monotonically_increasing_id().alias("at"), "*")


def numbered(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Written blocks with ``block``, 0, 1, 2, ... without gaps, and their number."""
    part = F.shiftright("at", 33)
    counts = blocks.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    before, total = [], 0
    for r in counts:
        before.append((r["part"], total))
        total += r["n"]
    # A row per partition of the table.
    offsets = blocks.sparkSession.createDataFrame(before, "part long, offset long")
    block = F.col("offset") + F.col("at") - F.shiftleft(part, 33)
    return blocks.join(F.broadcast(offsets), part == F.col("part")).select(block.alias("block"), "vec_id", "deviation", "rows"), total


def matrix(blocks: DataFrame, count: int, tall: int, dims: int, across: int = 1, centre: np.ndarray | None = None) -> BlockMatrix:
    """block, vec_id, rows as a BlockMatrix, ``across`` blocks side by side; all true rows less ``centre``, if given.

    Kept by the executors, as every product of MLlib reads its blocks several times; what is lost with an
    executor is made again from the written table.
    """

    def indexed(r) -> tuple:
        values = np.frombuffer(r["rows"], "<f8").reshape(tall, dims)
        if centre is not None:
            values = values.copy()
            values[: len(r["vec_id"])] -= centre
        return divmod(r["block"], across), DenseMatrix(tall, dims, values.ravel(), True)

    place = T.StructType([T.StructField("row", T.LongType()), T.StructField("col", T.LongType())])
    schema = T.StructType([T.StructField("at", place), T.StructField("matrix", MatrixUDT())])
    placed = blocks.sparkSession.createDataFrame(blocks.select("block", "vec_id", "rows").rdd.map(indexed), schema)
    java = callMLlibFunc("createBlockMatrix", placed, tall, dims, -(-count // across) * tall, across * dims)
    out = BlockMatrix(java, tall, dims)
    return out.persist(StorageLevel.MEMORY_AND_DISK)


def scatter(blocks: BlockMatrix, width: int) -> np.ndarray:
    """Transpose times itself of a matrix one block wide; ``width`` tasks or more, though the result is one block."""
    java = blocks._java_matrix_wrapper._java_model
    count = -(-blocks.numRows() // blocks.rowsPerBlock)
    # A task looks among all its blocks for the partner of each, so it gets few.
    splits = max(1, min(count, max(width, -(-count // 16))))
    product = java.transpose().multiply(java, splits)
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def projected(blocks: DataFrame, count: int, tall: int, whitening: np.ndarray) -> DataFrame:
    """block, rows: every row times the whitening matrix; written, as it reads a matrix that isn't kept.

    MLlib deals the result out as a square grid, a tall column of blocks to few tasks only. So the blocks
    stand in a square, and the whitening matrix on the diagonal.
    """
    spark = blocks.sparkSession
    dims, cols = whitening.shape
    across = math.isqrt(count - 1) + 1
    flat = whitening.ravel(order="F")
    diagonal = spark.sparkContext.parallelize(range(across)).map(lambda k: ((k, k), DenseMatrix(dims, cols, flat)))
    left = matrix(blocks, count, tall, dims, across)
    product = left.multiply(BlockMatrix(diagonal, dims, cols, across * dims, across * cols))

    def plain(b) -> tuple:
        (row, col), values = b
        return row * across + col, bytearray(values.toArray().astype("<f8").tobytes())

    out = written(spark.createDataFrame(product.blocks.map(plain), "block long, rows binary"), "whitened")
    freed(left)
    return out


def freed(matrix: BlockMatrix) -> None:
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)


def column_sums(blocks: DataFrame, cols: int) -> np.ndarray:
    """Sum of each column over all blocks; the rows they are filled up with are zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(0):
                part = np.frombuffer(rows.as_buffer(), "<f8").reshape(-1, cols).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(cols)), pa.array(part)], ["d", "s"])

    parts = blocks.select("rows").mapInArrow(run, "d long, s double").groupBy("d")
    return np.array([r["s"] for r in sorted(parts.agg(F.sum("s").alias("s")).collect())])


def opened(blocks: DataFrame, cols: int, facts: list[tuple[int, float, int | None]]) -> DataFrame:
    """vec_id, deviation, component, explained, whitened: a row per vector and (component, explained, column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, deviation, rows in zip(*batch.columns):
                ids, deviation = ids.values, deviation.values
                values = np.frombuffer(rows.as_buffer(), "<f8").reshape(-1, cols) if cols else None
                for component, explained, column in facts:
                    white = pa.nulls(len(ids), pa.float64()) if column is None else pa.array(values[: len(ids), column])
                    fixed = [pa.array(np.full(len(ids), component), pa.int32()), pa.array(np.full(len(ids), explained))]
                    yield pa.RecordBatch.from_arrays([ids, deviation, *fixed, white], ["vec_id", "deviation", "component", "explained", "whitened"])

    return blocks.select("vec_id", "deviation", "rows").mapInArrow(
        run, "vec_id long, deviation long, component int, explained double, whitened double"
    )


def whitened(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT,
    components: int = COMPONENTS,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Null and empty vectors and those with null or non-finite components are left out; where lengths differ,
    those of the commonest length remain (the longer of two equally common ones). Rows without vec_id and
    repeated rows count like any other. Components with equal eigenvalues come in any order; one without
    spread (an eigenvalue of 0) has null for ``whitened`` and no part in ``identity_error``. With fewer
    dimensions than ``components`` there are as many components as dimensions. A deviation that no long can
    hold is null. An empty table gives an empty one; extra columns, also of clashing names, are not read.
    A component beyond 2^40 after scaling stops the job.
    """
    spark = embeddings.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(kept(embeddings, id_col, vector_col, scale, shift), "kept")
    lengths = rows.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    dims, n = lengths[0]["dims"], lengths[0]["n"]
    chosen = rows.where(F.size("x") == dims)
    tall = min(TALLEST, max(BLOCK, -(-n // MOST_BLOCKS)))
    blocks, count = numbered(written(cut(chosen, sums(chosen, "x", dims), n, tall), "blocks"))
    dropped(rows)

    distributed = matrix(blocks, count, tall, dims)
    variance, vectors = np.linalg.eigh(scatter(distributed, width) / n)
    freed(distributed)
    order = np.argsort(-variance, kind="stable")[:components]
    trace = float(np.maximum(variance, 0).sum())
    spread = [k for k in order if variance[k] > FLAT * max(variance[order[0]], 0)]
    error = 0.0
    told = blocks
    if spread:
        found = projected(blocks, count, tall, vectors[:, spread] / np.sqrt(variance[spread]))
        told = blocks.drop("rows").join(found, "block")
        again = matrix(told, count, tall, len(spread), centre=column_sums(found, len(spread)) / n)
        error = float(np.abs(scatter(again, width) / n - np.eye(len(spread))).max())
        freed(again)
    facts = [(k + 1, float(max(variance[at], 0)) / trace if trace else 0.0, k if k < len(spread) else None) for k, at in enumerate(order)]
    out = opened(told, len(spread), facts)
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))

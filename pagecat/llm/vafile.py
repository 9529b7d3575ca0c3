"""Centroid clustering over a vector approximation file.

Every vector is kept twice: as a row of a few bits per dimension (the file of cells) and whole. A round
reads only the cells. Lookup tables of the squared distance from a cell to each centroid, least and
greatest, add up to an interval per centroid; where one interval lies below all others the cluster is known.
All distances are taken less the squared distance to the centroids' mean. That changes no comparison, but
drops what the intervals of a row have in common, so they are narrow where centroids lie close together.
Whole vectors are fetched only where intervals overlap, or where the cluster changed since the round before:
the new centroids follow from the old sums by what left and what came. The vectors are bucketed by row
number, so fetching shuffles row numbers only. All arithmetic is on integers and exact.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecat.llm.common import dropped, scratch, written
from pagecat.llm.vectors import binary, finite, id_vector, matrix, stacked

DIMS = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3
# Bits of a cell: the larger, the fewer intervals overlap and the more there is to read.
BITS = 8
# Rows whose quantiles give the borders of the cells; they decide what is fetched, never a result.
SAMPLE = 16_384
# Components beyond this would overflow a squared distance in 64 bits.
LARGEST = 1 << 27
# Rows one step holds as a matrix of distances.
ROWS = 4096


@dataclass
class Fit:
    """Centroids as integers, and how many vectors each round fetched."""

    centroids: np.ndarray
    rows: int
    fetched: list[int] = field(default_factory=list)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid per row (the smaller of equals) and its squared distance, exact."""
    cluster = np.zeros(len(x), np.int64)
    distance = np.zeros(len(x), np.int64)
    for begin in range(0, len(x), ROWS):
        part = x[begin : begin + ROWS].astype(np.int64)
        all_distances = np.stack([((part - c) ** 2).sum(axis=1) for c in centroids], axis=1)
        own = all_distances.argmin(axis=1)
        cluster[begin : begin + ROWS] = own
        distance[begin : begin + ROWS] = all_distances[np.arange(len(part)), own]
    return cluster, distance


def lookup(edges: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Per dimension and cell, the least and then the greatest squared distance to each centroid's component,
    less that to the component of the centroids' mean.

    ``edges`` holds the first integer of each cell of a dimension, and one past the last.
    """
    mean = centroids.sum(axis=0) // len(centroids)
    slope = -2 * (centroids - mean).T[:, None, :]
    fixed = (centroids**2 - mean**2).T[:, None, :]
    ends = np.stack([edges[:, :-1, None] * slope + fixed, (edges[:, 1:, None] - 1) * slope + fixed])
    return np.concatenate([ends.min(axis=0), ends.max(axis=0)], axis=2)


def decided(cells: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The only cluster that a row's intervals leave, or -1 where intervals overlap."""
    count = tables.shape[2] // 2
    out = np.empty(len(cells), np.int64)
    for begin in range(0, len(cells), ROWS):
        part = cells[begin : begin + ROWS]
        bounds = np.zeros((len(part), 2 * count), np.int64)
        for d in range(part.shape[1]):
            bounds += tables[d][part[:, d]]
        least = bounds[:, :count]
        open_ = least <= bounds[:, count:].min(axis=1)[:, None]
        out[begin : begin + ROWS] = np.where(open_.sum(axis=1) == 1, least.argmin(axis=1), -1)
    return out


def kept(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """row, vec_id, x: vectors of ``dims`` finite components, each floor(scale * component), as bytes of 32-bit integers."""
    rows = id_vector(embeddings, id_col, vector_col).where((F.size("v") == dims) & finite(F.col("v")))
    rows = rows.select("vec_id", F.transform("v", lambda c: F.floor(c * float(scale))).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = stacked(batch.column(1), dims)
            if len(x) and max(x.max(), -x.min()) > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} after scaling; its distances don't fit a long")
            yield pa.RecordBatch.from_arrays([batch.column(0), binary(x.astype("<i4"))], ["vec_id", "x"])

    return rows.mapInArrow(run, "vec_id long, x binary").select(F.monotonically_increasing_id().alias("row"), "vec_id", "x")


def seeds(rows: DataFrame, dims: int, count: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:id``, in that order; equal ones by their bytes."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select("x", digest.alias("digest")).orderBy("digest", "x").limit(count).collect()
    return np.array([np.frombuffer(r["x"], "<i4") for r in first], np.int64).reshape(len(first), dims)


def borders(rows: DataFrame, dims: int, bits: int = BITS, sample: int = SAMPLE) -> np.ndarray:
    """First integer of every cell per dimension, and one past the last, over the exact range of all rows."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0), "<i4", dims)
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["d", "low", "high"])

    found = rows.select("x").mapInArrow(ranges, "d long, low long, high long").groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    found = sorted(tuple(r) for r in found)
    some = rows.select("x").orderBy(F.xxhash64("row")).limit(sample).toArrow().column("x").combine_chunks()
    share = np.arange(1, 1 << bits) / (1 << bits)
    ends = np.quantile(matrix(some, "<i4", dims), share, axis=0)
    wide = np.quantile(matrix(some, "<i4", dims), [0.001, 0.999], axis=0)
    # Between equal counts and equal widths: the cells of the tails stay narrow too.
    inner = np.floor((ends + wide[0] + (wide[1] - wide[0]) * share[:, None]) / 2).astype(np.int64)
    edges = np.empty((dims, (1 << bits) + 1), np.int64)
    for d, low, high in found:
        edges[d] = np.concatenate([[low], np.clip(inner[:, d], low, high + 1), [high + 1]])
    return edges


def approximated(rows: DataFrame, edges: np.ndarray) -> DataFrame:
    """row, cells: one byte per dimension, the number of its cell."""
    dims = len(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), "<i4", dims)
            cells = np.empty(x.shape, np.uint8)
            for d in range(dims):
                cells[:, d] = np.searchsorted(edges[d, 1:-1], x[:, d], side="right")
            yield pa.RecordBatch.from_arrays([batch.column(0), binary(cells)], ["row", "cells"])

    return rows.select("row", "x").mapInArrow(run, "row long, cells binary")


def bucketed(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder, dealt and sorted by row, whose joins by row need no exchange."""
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(width, "row").write.option("path", scratch(spark, name))
    dealt.bucketBy(width, "row").sortBy("row").saveAsTable(name)
    return spark.read.table(name)


def moved(vectors: DataFrame, old: np.ndarray | None, new: np.ndarray) -> dict[int, int]:
    """Sums by slot of what the vectors bring to each cluster and take from it: dims components, then a count."""
    dims, count = new.shape[1], len(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((count, dims + 1), np.int64)
        fetched = 0
        for batch in batches:
            x = matrix(batch.column(0), "<i4", dims)
            fetched += len(x)
            to = nearest(x, new)[0]
            away = np.full(len(x), -1) if old is None else nearest(x, old)[0]
            for k in range(count):
                come, gone = x[(to == k) & (away != k)], x[(away == k) & (to != k)]
                sums[k, :dims] += come.sum(axis=0, dtype=np.int64) - gone.sum(axis=0, dtype=np.int64)
                sums[k, dims] += len(come) - len(gone)
        slots = np.arange(count * (dims + 1) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(np.append(sums.ravel(), fetched))], ["slot", "s"])

    total = vectors.select("x").mapInArrow(run, "slot long, s long").groupBy("slot")
    return {r["slot"]: int(r["s"]) for r in total.agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}


def open_rows(cells: DataFrame, edges: np.ndarray, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """Rows whose intervals overlap under the old or the new centroids, or lead to another cluster than before."""
    before, now, dims = lookup(edges, old), lookup(edges, new), len(edges)

    @F.arrow_udf("boolean")
    def must(column: pa.Array) -> pa.Array:
        c = matrix(column, np.uint8, dims)
        a, b = decided(c, before), decided(c, now)
        return pa.array((a < 0) | (b < 0) | (a != b))

    return cells.where(must("cells")).select("row")


def fit(rows: DataFrame, dims: int = DIMS, count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, bits: int = BITS) -> Fit:
    """Centroids after ``rounds`` rounds over a written table of ``kept`` rows.

    A round that moves no centroid ends the work, as all later ones would repeat it.
    """
    spark = rows.sparkSession
    new = seeds(rows, dims, count, seed)
    found = Fit(new, 0)
    if not len(new) or not rounds:
        return found
    edges = borders(rows, dims, bits)
    name = f"llm_vectors_{uuid.uuid4().hex}"
    tables: list[DataFrame] = []
    try:
        cells = written(approximated(rows, edges), "cells")
        tables.append(cells)
        vectors = bucketed(rows.select("row", "x"), name)
        tables.append(vectors)
        sums = np.zeros((len(new), dims + 1), object)
        old = None
        for _ in range(rounds):
            fetched = vectors if old is None else vectors.join(open_rows(cells, edges, old, new).hint("merge"), "row")
            change = moved(fetched, old, new)
            last = len(new) * (dims + 1)
            found.fetched.append(change.get(last, 0))
            sums += np.array([change.get(s, 0) for s in range(last)], object).reshape(len(new), dims + 1)
            old, new = new, np.array([[int(s) // n for s in total] if n else c.tolist() for (*total, n), c in zip(sums, new)], np.int64)
            if (old == new).all():
                break
    finally:
        for table in tables:
            dropped(table)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return Fit(new, int(sums[:, dims].sum()), found.fetched)


def assigner(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = nearest(matrix(batch.column(1), "<i4", centroids.shape[1]), centroids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return run


def clustered(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE,
    count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, bits: int = BITS,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector of ``dims`` finite components.

    Null vectors, those of another length and those with null or non-finite components are left out. Rows
    without vec_id take part (their id counts as an empty text where seeds are chosen) and repeated rows count
    as often as they occur. Equal distances go to the smaller cluster number; a cluster that loses all its
    vectors keeps its centroid. With fewer vectors than ``count`` there are as many clusters as vectors. An
    empty table gives an empty one. Extra columns, also of clashing names, are not read. A component beyond
    2^27 after scaling stops the job, as its squared distance would not fit a long.
    The last assignment gives every row its distance, so it reads every vector once.
    """
    spark = embeddings.sparkSession
    rows = written(kept(embeddings, id_col, vector_col, dims, scale), "kept")
    model = fit(rows, dims, count, rounds, seed, bits)
    centroids = model.centroids if len(model.centroids) else np.zeros((1, dims), np.int64)
    assigned = written(rows.select("vec_id", "x").mapInArrow(assigner(centroids), "vec_id long, cluster int, distance long"), "assigned")
    dropped(rows)
    by_cluster = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(by_cluster.values())
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    told = spark.createDataFrame(
        [(k, by_cluster.get(k, 0), total, digest) for k, digest in enumerate(digests)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # One row per centroid: as many as ``count``, so it may be sent to every task.
    return assigned.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

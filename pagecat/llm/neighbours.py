"""Near-duplicate embeddings by an inverted multi-index.

Two codebooks, one for each half of a vector, span a grid of cells. Every vector lies in one cell. A vector's
traversal visits cells in order of their squared distance (the sum over both halves), from its own outwards,
until the cells hold the wanted share of partners at the least similarity; how far that is is measured on
simulated partners, and on the true links, of a sample. Vectors met in a visited cell are compared whole, in double precision.
Equal vectors are one entry with a count. Cells of one first code lie together in a shard, so a vector is
sent once per shard, not once per cell; large shards are split into blocks that meet pairwise. A block gives
numbers of links and a spanning forest, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecat.llm.common import dropped, written
from pagecat.llm.simhash import components
from pagecat.llm.vectors import binary, finite, id_vector

COSINE = 0.9
# Share of partners at just COSINE that one of the two traversals must reach.
RECALL = 0.999
# Different vectors the codebooks and the reach of the traversal are fitted on; all are indexed.
SAMPLE = 16_384
# Of these, so many are compared with each other, for the reach of true links.
LINKED = 4096
# Vectors a cell holds on average, until codebooks have MOST_CODES codes.
PER_CELL = 64
MOST_CODES = 1024
# Entries, and queries, that meet in one block.
BLOCK = 4096
# Queries compared at a time.
ROWS = 512
# Halves are coded in integers of this unit, so that distances are exact and alike in every task.
UNIT = float(1 << 14)


@dataclass
class Index:
    """Codebooks (integers as doubles), group of each second code, and how far beyond the nearest cell to go."""

    dims: int
    first: np.ndarray
    second: np.ndarray
    group: np.ndarray
    groups: int
    reach: float

    def halves(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of both halves to all codes, each less the smallest of its row."""
        q = np.rint(units * UNIT)
        half = self.first.shape[1]
        out = []
        for part, codes in ((q[:, :half], self.first), (q[:, half:], self.second)):
            d = (part**2).sum(axis=1)[:, None] - 2 * part @ codes.T + (codes**2).sum(axis=1)
            out.append(d - d.min(axis=1)[:, None])
        return out[0], out[1]


def units(column: pa.Array, kind: str, dims: int) -> np.ndarray:
    """Vectors of a binary column at length 1, filled up with zeros to ``dims``."""
    out = np.zeros((len(column), dims))
    if len(column):
        data = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        raw = [np.frombuffer(v.as_buffer(), kind) for v in data]
        sizes = {len(r) for r in raw}
        if len(sizes) == 1:
            out[:, : sizes.pop()] = np.stack(raw)
        else:
            for row, r in zip(out, raw):
                row[: len(r)] = r
        out /= np.abs(out).max(axis=1)[:, None]
        out /= np.sqrt((out**2).sum(axis=1))[:, None]
    return out


def codebook(x: np.ndarray, codes: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centroids of ``codes`` clusters, as integers in UNIT."""
    x = np.rint(x * UNIT)
    centres = x[rng.choice(len(x), min(codes, len(x)), replace=False)]
    for _ in range(rounds):
        own = ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        counts = np.bincount(own, minlength=len(centres))
        centres[counts > 0] = np.rint(total[counts > 0] / counts[counts > 0, None])
    return centres


def build(sample: np.ndarray, n: int, cosine: float = COSINE, recall: float = RECALL, per_cell: int = PER_CELL, block: int = BLOCK) -> Index:
    """The index for ``n`` different vectors, fitted on some of them at length 1."""
    rng = np.random.default_rng(1)
    dims = sample.shape[1]
    half = dims // 2
    codes = int(min(MOST_CODES, max(4, np.ceil(np.sqrt(n / per_cell)))))
    first, second = codebook(sample[:, :half], codes, rng), codebook(sample[:, half:], codes, rng)
    # Second codes that lie along one direction go together, in as many groups as fill the blocks.
    axis = np.linalg.svd(second - second.mean(axis=0), full_matrices=False)[2][0]
    groups = int(min(len(second), max(1, -(-n // (codes * block)))))
    group = (np.argsort(np.argsort(second @ axis, kind="stable"), kind="stable") * groups) // len(second)
    index = Index(dims, first, second, group, groups, 0.0)
    some = sample[rng.integers(0, len(sample), 20_000)]
    apart = rng.normal(size=some.shape)
    apart[some == 0] = 0  # a shorter vector's partner is as short
    apart -= (apart * some).sum(axis=1)[:, None] * some
    length = np.sqrt((apart**2).sum(axis=1))[:, None]
    partner = cosine * some + np.sqrt(1 - cosine**2) * np.divide(apart, length, out=np.zeros_like(apart), where=length > 1e-9)
    one, two = [index.halves(x) for x in (some, partner)]
    rows = np.arange(len(some))
    to = one[0][rows, two[0].argmin(axis=1)] + one[1][rows, two[1].argmin(axis=1)]
    back = two[0][rows, one[0].argmin(axis=1)] + two[1][rows, one[1].argmin(axis=1)]
    index.reach = float(np.quantile(np.minimum(to, back), recall, method="higher"))
    far = _farthest_links(index, sample[:LINKED], cosine)
    if len(far):
        index.reach = max(index.reach, float(np.quantile(far, recall, method="higher")))
    return index


def _farthest_links(index: Index, some: np.ndarray, cosine: float) -> np.ndarray:
    """For each of some vectors with links among them, how far the traversal goes to the farthest.

    Partners in a dense group lie where codes are dense too, unlike simulated ones.
    """
    a, b = index.halves(some)
    first, second = a.argmin(axis=1), b.argmin(axis=1)
    out = np.full(len(some), -1.0)
    for begin in range(0, len(some), ROWS):
        q, e = np.nonzero(some[begin : begin + ROWS] @ some.T >= cosine)
        q += begin
        to, back = a[q, first[e]] + b[q, second[e]], a[e, first[q]] + b[e, second[q]]
        np.maximum.at(out, q[q != e], np.minimum(to, back)[q != e])
    return out[out >= 0]


def postings(classes: DataFrame, index: Index, kind: str, blocks: dict[int, tuple[int, int]] | None) -> DataFrame:
    """Entries (query false) and queries by shard; with ``blocks``, also by block and with all that is compared.

    ``blocks`` holds, for shards of more than one block, how many blocks of entries and of queries there are.
    """
    item = np.dtype(kind).itemsize
    many = np.array(sorted(blocks or ()), np.int64)
    schema = "shard long, query boolean"
    if blocks is not None:
        schema += ", part long, node long, copies long, v binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            column = batch.column(2)
            node = batch.column(0).to_numpy()
            length = np.array([len(v.as_buffer()) // item for v in column], np.int64)
            a, b = index.halves(units(column, kind, index.dims))
            base = length * len(index.first)
            own = (base + a.argmin(axis=1)) * index.groups + index.group[b.argmin(axis=1)]
            row, code = np.nonzero(a <= index.reach)
            reached = b[row] <= (index.reach - a[row, code])[:, None]
            hit = np.stack([reached[:, index.group == g].any(axis=1) for g in range(index.groups)], axis=1)
            at, g = np.nonzero(hit)
            rows = np.concatenate([np.arange(len(node)), row[at]])
            shard = np.concatenate([own, (base[row[at]] + code[at]) * index.groups + g])
            query = np.arange(len(rows)) >= len(node)
            if blocks is None:
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(query)], ["shard", "query"])
                continue
            large = np.isin(shard, many)
            out_rows, parts = [np.flatnonzero(~large)], [np.zeros(int((~large).sum()), np.int64)]
            for k in np.flatnonzero(large).tolist():
                entries, queries = blocks[int(shard[k])]
                mixed = (int(node[rows[k]]) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 24
                if query[k]:
                    places = (np.arange(entries) << 32) | mixed % queries
                else:
                    places = (mixed % entries << 32) | np.arange(queries)
                out_rows.append(np.full(len(places), k))
                parts.append(places)
            pick = np.concatenate(out_rows)
            from_row = pa.array(rows[pick])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard[pick]), pa.array(query[pick]), pa.array(np.concatenate(parts), pa.int64()),
                    batch.column(0).take(from_row), batch.column(1).take(from_row), column.take(from_row),
                ],
                ["shard", "query", "part", "node", "copies", "v"],
            )

    return classes.select("node", "copies", "v").mapInArrow(run, schema)


class _Block:
    """Entries of one block, and what the queries found so far."""

    def __init__(self, index: Index, shard: int, cosine: float):
        self.index, self.cosine = index, cosine
        self.code = shard // index.groups % len(index.first)
        self.parts: list[tuple] = []
        self.ready = False

    def add(self, node: np.ndarray, copies: np.ndarray, u: np.ndarray) -> None:
        self.parts.append((node, copies, u))

    def close(self) -> None:
        node, copies, u = (np.concatenate(p) for p in zip(*self.parts))
        code = self.index.halves(u)[1].argmin(axis=1)
        order = np.argsort(code, kind="stable")
        self.node, self.copies, self.u = node[order], copies[order], u[order]
        self.a, self.b = self.index.halves(self.u)
        codes, starts = np.unique(code[order], return_index=True)
        self.cells = list(zip(codes.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)]))
        self.label = np.arange(len(node))
        self.links = np.zeros(len(node), np.int64)
        self.ready = True

    def meet(self, node: np.ndarray, copies: np.ndarray, u: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """Compare queries with the entries of the cells they visit; counts and edges of the queries."""
        index = self.index
        a, b = index.halves(u)
        rest = index.reach - a[:, self.code]
        found_q, found_e = [], []
        for code, begin, end in self.cells:
            visiting = np.flatnonzero(b[:, code] <= rest)
            if len(visiting):
                q, e = np.nonzero(u[visiting] @ self.u[begin:end].T >= self.cosine)
                found_q.append(visiting[q])
                found_e.append(e + begin)
        if not found_q:
            return []
        q, e = np.concatenate(found_q), np.concatenate(found_e)
        # A pair that both traversals reach counts where the smaller node asks.
        back = self.a[e, a.argmin(axis=1)[q]] + self.b[e, b.argmin(axis=1)[q]] <= index.reach
        once = np.where(back, node[q] < self.node[e], node[q] != self.node[e])
        q, e = q[once], e[once]
        if not len(q):
            return []
        np.add.at(self.links, e, copies[q])
        mine = np.zeros(len(node), np.int64)
        np.add.at(mine, q, self.copies[e])
        held = len(self.label)
        label = np.concatenate([self.label, held + np.arange(len(node))])
        x, y = np.concatenate([e, np.arange(held)]), np.concatenate([q + held, self.label])
        while True:
            low = np.minimum(label[x], label[y])
            np.minimum.at(label, x, low)
            np.minimum.at(label, y, low)
            label = label[label]
            if (label[x] == label[y]).all():
                break
        self.label = label[:held]
        linked = np.unique(q)
        return [(node[linked], mine[linked], 0), (node[linked], self.node[label[held + linked]], 1)]

    def end(self) -> list[tuple[np.ndarray, np.ndarray, int]]:
        linked = self.links > 0
        joined = self.label != np.arange(len(self.label))
        return [(self.node[linked], self.links[linked], 0), (self.node[joined], self.node[self.label[joined]], 1)]


def compared(posted: DataFrame, index: Index, kind: str, cosine: float = COSINE) -> DataFrame:
    """edge, a, b: numbers of links b of a node a (edge 0, in parts), and edges of a spanning forest (edge 1)."""

    def batch_of(parts: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
        a, b = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        edge = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
        return pa.RecordBatch.from_arrays([pa.array(edge, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["edge", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            shard, query, part, node, copies = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            u = units(batch.column(5), kind, index.dims)
            ends = np.flatnonzero((shard[1:] != shard[:-1]) | (part[1:] != part[:-1]) | (query[1:] != query[:-1])) + 1
            for begin, end in zip([0, *ends.tolist()], [*ends.tolist(), len(shard)]):
                now = int(shard[begin]), int(part[begin])
                rows = slice(begin, end)
                if now != key:
                    if block is not None and block.ready:
                        yield batch_of(block.end())
                    key, block = now, _Block(index, now[0], cosine)
                if not query[begin]:
                    block.add(node[rows], copies[rows], u[rows])
                elif block.parts:
                    if not block.ready:
                        block.close()
                    out = block.meet(node[rows], copies[rows], u[rows])
                    if out:
                        yield batch_of(out)
        if block is not None and block.ready:
            yield batch_of(block.end())

    width = int(posted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = posted.repartition(width, "shard", "part").sortWithinPartitions("shard", "part", "query")
    return dealt.select("shard", "query", "part", "node", "copies", "v").mapInArrow(run, "edge int, a long, b long")


def distinct_vectors(rows: DataFrame, kind: str) -> DataFrame:
    """node, k1, k2, least, copies, v: different vectors with the smallest id and the number of rows that hold them."""
    once = rows.groupBy("k1", "k2", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            sizes = pc.list_value_length(lists).to_numpy()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
            if len(set(sizes.tolist())) == 1:
                v = binary(flat.reshape(len(sizes), -1))
            else:
                v = pa.array([p.tobytes() for p in np.split(flat, np.cumsum(sizes)[:-1])], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], v], ["k1", "k2", "least", "copies", "v"])

    coded = once.select("k1", "k2", "least", "copies", "v").mapInArrow(run, "k1 long, k2 long, least long, copies long, v binary")
    return coded.select(F.monotonically_increasing_id().alias("node"), "*")


def near_duplicates(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, recall: float = RECALL,
    per_cell: int = PER_CELL, block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Rows whose vectors have a cosine of at least ``cosine`` are linked; n_links counts rows, copies among them.
    component_id is the smallest vec_id reachable by links. Null, empty and zero vectors and those with null or
    non-finite components link with nothing, vectors of different lengths not with each other. Repeated rows
    link like other copies. A null vec_id is never a component_id, unless its component has no other (null);
    ``kept`` is then true where both are null. An empty table gives an empty one; extra columns are not read.
    """
    spark = embeddings.sparkSession
    kind = "<f4" if dict(embeddings.dtypes)[vector_col] == "array<float>" else "<f8"
    rows = id_vector(embeddings, id_col, vector_col)
    usable = finite(F.col("v")) & F.coalesce(F.exists("v", lambda c: c != 0), F.lit(False))
    keyed = rows.where(usable).select("vec_id", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit("second"), F.col("v")).alias("k2"))
    classes = written(distinct_vectors(keyed, kind), "vectors")
    item = np.dtype(kind).itemsize
    n, longest = classes.agg(F.count("*"), F.max(F.octet_length("v"))).first()
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not n:
        return alone
    dims = max(2, longest // item)
    some = classes.orderBy(F.xxhash64("k1"), "k1").select("v").limit(SAMPLE).toArrow().column("v")
    index = build(units(some, kind, dims), n, cosine, recall, per_cell, block)

    sizes = postings(classes, index, kind, None).groupBy("shard").agg(
        F.count_if(~F.col("query")).alias("entries"), F.count_if("query").alias("queries")
    )
    # At most one row per shard: codes times groups, both bounded by MOST_CODES.
    large = sizes.where((F.col("entries") > block) | ((F.col("entries") > 0) & (F.col("queries") > 4 * block))).collect()
    blocks = {r["shard"]: (-(-r["entries"] // block), -(-r["queries"] // (4 * block))) for r in large}
    found = written(compared(postings(classes, index, kind, blocks), index, kind, cosine), "links")
    links = found.where("edge = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    root = components(found.where("edge = 1").select("a", "b"), "components")
    known = classes.select("node", "k1", "k2", "least", "copies").join(links, "node", "left").join(root, "node", "left")
    known = written(known.select("k1", "k2", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root")), "known")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    told = written(known.join(least, "root").select("k1", "k2", "n_links", "component_id"), "told")
    dropped(known)
    linked = keyed.select("vec_id", "k1", "k2").join(told, ["k1", "k2"])
    linked = linked.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return linked.unionByName(alone)

"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprints of 64 bits that differ in at most 4 bits differ in at most 4 bytes, so at least 4 of their 8
positional bytes are equal. Postings of the index are kept for four positions together: two
fingerprints meet in a list only if they share the guaranteed number of bytes. Within a list, shared
positional bytes are tallied, pairs that reach the guaranteed minimum are kept and verified by their
bits. Equal fingerprints are one entry, so exact copies cost nothing; a long list is split into
blocks that meet pairwise; and a list gives a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecat.llm.common import by_bytes, fresh, id_text, written

SEED = 42
SHINGLE = 4
BITS = 4
BYTES = 8
SHARED = BYTES - BITS
# Members of a list that one task compares at a time.
BLOCK = 2048
POSITIONS = list(combinations(range(BYTES), SHARED))
ONES = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased; a text of fewer words than
    a shingle is one shingle. A bit is 1 if it is set in over half of the hashes.
    """
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())], "<u8")
    counts = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), 1 << 16):
        part = hashes[begin : begin + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fp (as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(ids: list, texts: list) -> pa.RecordBatch:
            fps = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fps, pa.int64())], ["doc_id", "fp"])

        return by_bytes(batches, work)

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def postings(fps: DataFrame) -> DataFrame:
    """list, fp: an entry in the list of every choice of four positions, named by the choice and its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(begin, 4096).to_numpy(zero_copy_only=False)
                byte = fp.view(np.uint8).reshape(-1, BYTES).astype(np.int64)
                keys = np.empty((len(POSITIONS), len(fp)), np.int64)
                for k, chosen in enumerate(POSITIONS):
                    keys[k] = k
                    for p in chosen:
                        keys[k] = (keys[k] << 8) | byte[:, p]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.tile(fp, len(POSITIONS)))], ["list", "fp"])

    return fps.mapInArrow(run, "list long, fp long")


def _first_choice(equal: np.ndarray) -> np.ndarray:
    """Number of the first choice of positions within those marked equal, per row."""
    order = np.argsort(~equal, axis=1, kind="stable")[:, :SHARED]
    weights = 1 << np.arange(BYTES)
    return _CHOICE[(weights[order]).sum(axis=1)]


_CHOICE = np.full(1 << BYTES, -1, np.int64)
for _k, _c in enumerate(POSITIONS):
    _CHOICE[sum(1 << p for p in _c)] = _k


def list_links(name: int, fps: np.ndarray, cut: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within one list; with ``cut``, only links across that place count.

    A link is left to the first list that holds both ends: there they are connected too.
    """
    left = np.arange(len(fps))
    bits = fps.view(np.uint64)
    out_a, out_b = [], []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            u = queue.pop()
            rest = left if cut is None else left[(left >= cut) != (u >= cut)]
            x = bits[rest] ^ bits[u]
            differing = x.view(np.uint8).reshape(-1, BYTES)
            tally = (differing == 0).sum(axis=1)
            enough = tally >= SHARED
            near = np.zeros(len(rest), bool)
            near[enough] = ONES[x[enough].view(np.uint16).reshape(-1, 4)].sum(axis=1) <= BITS
            if near.any():
                found = rest[near]
                own = _first_choice(differing[near] == 0) == name >> (8 * SHARED)
                out_a.append(np.full(int(own.sum()), fps[u]))
                out_b.append(fps[found[own]])
                queue.extend(found.tolist())
                left = np.setdiff1d(left, found, assume_unique=True)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def links(fps: DataFrame) -> DataFrame:
    """a, b: links between distinct fingerprints that connect all those within four bits of each other."""
    spark = fps.sparkSession
    entries = written(postings(fps), "postings")
    # Lists of one entry link nothing. Both sides are plain tables, so a hot list can be split at run time;
    # the join is the same at every size.
    sizes = written(entries.groupBy("list").agg(F.count("*").alias("n")).where("n > 1"), "lists")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    member = entries.join(sizes.hint("merge"), "list").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = member.select("list", "fp", "own", other.alias("other")).select(
        "list", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "fp"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held_own, held_fp = None, [], []

        def linked() -> pa.RecordBatch:
            own, fp = np.concatenate(held_own), np.concatenate(held_fp)
            if key[1] != key[2]:  # two blocks: only links between them, each block meets itself elsewhere
                order = np.argsort(own, kind="stable")
                own, fp = own[order], fp[order]
                cut = int(np.searchsorted(own, key[2]))
            else:
                cut = None
            a, b = list_links(key[0], fp, cut)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(columns[0]):
                continue
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)) + 1
            for begin, end in zip([0, *change.tolist()], [*change.tolist(), len(columns[0])]):
                now = tuple(int(c[begin]) for c in columns[:3])
                if now != key:
                    if key is not None and sum(map(len, held_fp)) > 1:
                        yield linked()
                    key, held_own, held_fp = now, [], []
                held_own.append(columns[3][begin:end])
                held_fp.append(columns[4][begin:end])
        if key is not None and sum(map(len, held_fp)) > 1:
            yield linked()

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.repartition(width, "list", "low", "high").sortWithinPartitions("list", "low", "high")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, root: the smallest node that each node of the edges (a, b) can reach.

    Alternating large and small stars; each round is written to the shared folder. A hub's edges are
    aggregated to its minimum in the tasks before they are shuffled.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name)
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), name)
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), name)
        lower = written(large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lower.select("a", F.col("m").alias("b")))
        now = written(small.where("a <> b").distinct(), name)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hexadecimal digits), component_id of every row.

    component_id is the smallest doc_id reachable over links of at most four differing bits. Null,
    empty and blank texts have fingerprint zero and are linked like any other. Repeated rows give repeated
    rows in one component. A null doc_id is never a component_id, unless no other id is there (null).
    An empty table gives an empty one.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    entries = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    root = components(links(entries.select("fp")), "components")
    rooted = entries.join(root, entries["fp"] == root["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    classes = written(rooted.join(least, "root").select("fp", "component_id"), "classes")
    return rows.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """All columns of one document of each component of fingerprints at most four bits apart.

    The one with the smallest doc_id stays, rows without a doc_id come last; of several texts under that
    id the one with the smallest hash, of rows that share both any one. Null, empty and blank texts are
    linked like any other. An empty table gives an empty one; columns of any name pass through.
    """
    key, digest = fresh(docs, "doc", "digest")
    text = F.col("text").cast("string")
    keyed = docs.withColumns({key: F.col("doc_id").cast("long"), digest: F.xxhash64(text)})
    named = keyed.select(F.struct(F.col(key).alias("id"), F.col(digest).alias("hash")).alias("key"), text.alias("text"))
    rows = written(_fingerprints_by_key(named, shingle, seed), "fingerprints")
    counted = rows.groupBy("fp", "id", "hash").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash", "n")).alias("row")
    entries = written(counted.groupBy("fp").agg(first), "distinct")
    root = components(links(entries.select("fp")), "components")
    rooted = entries.join(root, entries["fp"] == root["node"], "left").select("row", F.coalesce("root", "fp").alias("root"))
    kept = written(rooted.groupBy("root").agg(F.min("row").alias("row")).select("row.*"), "kept")

    def of(chosen: DataFrame) -> DataFrame:
        same = keyed[key].eqNullSafe(chosen["id"]) & (keyed[digest] == chosen["hash"])
        return keyed.join(chosen, same, "left_semi")

    out = of(kept.where("n = 1"))
    if not kept.where("n > 1").isEmpty():
        out = out.unionByName(of(kept.where("n > 1")).dropDuplicates([key, digest]))
    return out.drop(key, digest)


def _fingerprints_by_key(rows: DataFrame, shingle: int, seed: int) -> DataFrame:
    """id, hash, fp of rows of (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(keys: list, texts: list) -> pa.RecordBatch:
            fps = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64)
            columns = [pa.array([k["id"] for k in keys], pa.int64()), pa.array([k["hash"] for k in keys], pa.int64()), pa.array(fps, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["id", "hash", "fp"])

        return by_bytes(batches, work)

    return rows.select("key", "text").mapInArrow(run, "id long, hash long, fp long")

"""Training-order materialisation: token ids in a keyed random order, in shards of fixed stride.

Texts become token ids, each text closed by an end id, and the ids of a task are packed into sequences
of equal length. Every sequence has a number (tasks in order, then its place in the task); a keyed
Feistel permutation with cycle-walking maps the numbers one-to-one to slots of the same range, so no
slot is empty and the order needs no sort of random keys. Ranges of slots are shards: a task writes each
as one file of fixed stride, so the sequence of slot s begins at byte (s mod per shard) * stride, and a
reader resumes anywhere.
"""

from __future__ import annotations

import hashlib
import os
import sys
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecat.llm.common import BATCH_BYTES, id_text, scratch, written
from pagecat.llm.counts import part_ids, safe_parts

LENGTH = 2048
PER_SHARD = 4096
# Sequences compressed together before they are dealt out.
TOGETHER = 32
ROUNDS = 6
END = 2  # the end-of-text id of the vocabulary
PADDING = 0


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def round_keys(key: int) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{key}/{k}".encode()).digest()[:8], "little") for k in range(ROUNDS)]


def slots(numbers: np.ndarray, total: int, key: int) -> np.ndarray:
    """The slot of each number below ``total``: a permutation of 0 .. total - 1 chosen by the key.

    Feistel rounds permute the least even number of bits that holds the range; a value that falls outside
    is permuted again until it falls inside.
    """
    x = np.asarray(numbers, np.uint64).copy()
    half = max(1, -(-max(total - 1, 1).bit_length() // 2))
    width, mask = np.uint64(half), np.uint64((1 << half) - 1)
    keys = round_keys(key)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> width, x[todo] & mask
        for k in keys:
            left, right = right, left ^ (_mix(right, k) & mask)
        x[todo] = (left << width) | right
        todo = todo[x[todo] >= total]
    return x.astype(np.int64)


@lru_cache(maxsize=1)
def _codec():
    """Compressor and decompressor, once per Python worker."""
    import zstandard

    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _squeezed(ids: np.ndarray) -> bytes:
    """Ids of 16 bits, compressed for what is moved and stored in between."""
    return _codec()[0].compress(ids.astype("<u2").tobytes())


def _expanded(data: bytes) -> bytes:
    return _codec()[1].decompress(data)


def sequences(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """part, at, doc_ids, n_tokens, ids: the packed sequences of every task, in order, some to a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids = bytearray()  # 16 bits each
        names: list[int | None] = []  # doc_ids of the texts in ids, and where each begins
        starts: list[int] = []
        at = 0
        end_id = END.to_bytes(2, sys.byteorder)

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, names, starts, at
            values = np.frombuffer(bytes(ids), np.uint16)
            count = -(-len(values) // length) if last else len(values) // length
            for first in range(0, count, TOGETHER):
                begins = range(first * length, min(first + TOGETHER, count) * length, length)
                ends = [min(b + length, len(values)) for b in begins]
                # Every text has an id, so a text begins at each start and no two at one.
                inside = [names[bisect_right(starts, b) - 1 : bisect_left(starts, e)] for b, e in zip(begins, ends)]
                block = np.full(len(begins) * length, PADDING, np.uint16)
                block[: ends[-1] - begins[0]] = values[begins[0] : ends[-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([at], pa.int64()),
                        pa.array([inside], pa.list_(pa.list_(pa.int64()))),
                        pa.array([[e - b for b, e in zip(begins, ends)]], pa.list_(pa.int32())),
                        pa.array([_squeezed(block)], pa.binary()),
                    ],
                    ["part", "at", "doc_ids", "n_tokens", "ids"],
                )
                at += len(begins)
            begin = min(count * length, len(values))
            ids = ids[2 * begin :]
            kept = bisect_right(starts, begin) - 1 if ids else len(starts)
            names, starts = names[kept:], [max(0, p - begin) for p in starts[kept:]]

        for batch in batches:
            owners, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            held, first = 0, 0
            for i, text in enumerate(texts):
                held += len(text or "")
                if held < BATCH_BYTES // 4 and i + 1 < len(texts):
                    continue
                some = [safe_parts(t) if t else [] for t in texts[first : i + 1]]
                known = part_ids(tokenizer, some).__getitem__
                for name, parts in zip(owners[first : i + 1], some):
                    names.append(name)
                    starts.append(len(ids) // 2)
                    ids += b"".join(map(known, parts))
                    ids += end_id
                    if len(ids) >= 128 * length:
                        yield from cut(False)
                held, first = 0, i + 1
        yield from cut(True)

    return id_text(docs).mapInArrow(run, "part int, at long, doc_ids array<array<long>>, n_tokens array<int>, ids binary")


def materialised(
    docs: DataFrame, tokenizer: str, folder: str | None = None, key: int = 1, length: int = LENGTH, per_shard: int = PER_SHARD
) -> DataFrame:
    """slot, shard, offset, number, doc_ids, n_tokens, ids_sha256, path of every sequence, and the shard files.

    A null or empty text is its end id alone. Repeated rows are written as often as they occur, an empty
    table gives no rows and no files; other columns are not read. Files are little-endian unsigned
    16-bit ids under ``folder`` (any place pyarrow's file systems know; by default one in the shared
    folder), written aside and then renamed, so that a task that runs again leaves the same files.
    Numbers follow the input's partitions: the same files give the same order.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "shards")
    rows = written(sequences(docs, tokenizer, length), "sequences")
    ends = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.sum(F.size("n_tokens")).alias("n")).collect()}  # one per task
    starts, total = {}, 0
    for part in sorted(ends):
        starts[part] = total
        total += ends[part]
    shared = spark.sparkContext.broadcast(starts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = np.frombuffer(_expanded(row["ids"]), "<u2").reshape(-1, length)
                number = np.arange(len(block)) + shared.value[row["part"]] + row["at"]
                slot = slots(number, total, key)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(slot),
                        pa.array(slot // per_shard),
                        pa.array(number),
                        pa.array(row["doc_ids"], pa.list_(pa.int64())),
                        pa.array(row["n_tokens"], pa.int32()),
                        pa.array([_squeezed(x) for x in block], pa.binary()),
                    ],
                    ["slot", "shard", "number", "doc_ids", "n_tokens", "ids"],
                )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        shard, out, temporary = None, None, None

        def close() -> None:
            if out is not None:
                out.close()
                system.move(temporary, f"{root}/shard-{shard:08d}.bin")

        for batch in batches:
            hashes, paths = [], []
            for s, ids in zip(batch.column(1).to_pylist(), batch.column(5)):
                if s != shard:
                    close()
                    system.create_dir(root, recursive=True)
                    shard, temporary = s, f"{root}/.shard-{s:08d}-{uuid.uuid4().hex}"
                    out = system.open_output_stream(temporary)
                record = _expanded(ids.as_py())
                out.write(record)
                hashes.append(hashlib.sha256(record).hexdigest())
                paths.append(f"shard-{s:08d}.bin")
            slot, n = batch.column(0).to_numpy(), batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(slot % per_shard * 2 * length), *batch.columns[2:5], pa.array(hashes, pa.string()), pa.array([os.path.join(folder, p) for p in paths] if n else [], pa.string())],
                ["slot", "shard", "offset", "number", "doc_ids", "n_tokens", "ids_sha256", "path"],
            )
        close()

    placed = rows.mapInArrow(place, "slot long, shard long, number long, doc_ids array<long>, n_tokens int, ids binary")
    shards = max(1, -(-total // per_shard))
    ranges = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))
    # Slots are dense, so equal ranges of shards are equal amounts of data; a shard tells its range, no sample is drawn.
    dealt = placed.repartitionById(ranges, F.expr(f"cast(shard * {ranges} div {shards} as int)")).sortWithinPartitions("slot")
    done = dealt.mapInArrow(
        write, "slot long, shard long, offset long, number long, doc_ids array<long>, n_tokens int, ids_sha256 string, path string"
    )
    return written(done, "slots")


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> np.ndarray:
    """Ids of consecutive slots, read sequentially from the shard files; how a reader resumes at a slot."""
    system, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    stride, out = 2 * length, []
    while count > 0:
        shard, at = divmod(first, per_shard)
        n = min(count, per_shard - at)
        with system.open_input_file(f"{root}/shard-{shard:08d}.bin") as file:
            out.append(np.frombuffer(file.read_at(n * stride, at * stride), "<u2"))
        first, count = first + n, count - n
    return np.concatenate(out).reshape(-1, length) if out else np.empty((0, length), "<u2")

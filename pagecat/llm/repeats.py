"""Exact repeated passages by sorted suffix runs: every byte of a string of SIZE bytes that starts elsewhere too.

1. Texts are stored once each, bucketed by a key of their content, so that later steps join to them
   without moving them. A text held by two documents or more is repeated as a whole.
2. A window of SIZE bytes has an anchor, its substring of GRAM bytes with the least hash. Only anchors
   whose hash occurs twice can have equal windows (duplicate detection before strings are exchanged).
3. The suffix from the first window of each such anchor to the end of its last goes into a sorted run.
   Runs are written front-coded, cut by splitters, exchanged, and merged by a loser tree that never
   compares a known common prefix again. Equal suffixes repeat all their windows; a neighbour that
   shares SIZE bytes or more repeats the windows it covers.
4. Where a suffix isn't shared as a whole (the two ends of a passage), its windows are tested: in groups
   of SPAN by the bytes that all of the group share and by all its bytes, and one by one where these
   differ. Suffixes found equal take part once, as partners. Two 64-bit hashes stand for a string here.

Nothing depends on how many texts share a passage: equal strings are one entry per run, groups are
counted with partial aggregation, and every hash has its own row.
"""

from __future__ import annotations

import bisect
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecat.llm.common import dropped, fresh, id_text, reachable, written
from pagecat.llm.suffixes import Rolling, anchors, common_prefix, decoded, front_coded, merged

SIZE = 400
GRAM = 64
SPAN = 16
# Bytes of suffixes that one run sorts at a time, and suffixes in a written piece of a run.
RUN_BYTES = 32 << 20
PIECE = 2000
# One string in so many is a candidate for a splitter; of these some per partition are drawn.
SAMPLE_EVERY = 64
SPLITTERS_SAMPLED = 40

_PIECES = (
    "run long, base long, samples array<binary>, shared array<int>, lengths array<int>, rests binary, entries array<int>,"
    " k1 array<long>, k2 array<long>, first_start array<int>, last_start array<int>, anchor array<int>, gram array<long>"
)


def _array(column: pa.Array, kind: type) -> list[np.ndarray]:
    return [np.array(v if v is not None else [], kind) for v in column.to_pylist()]


class Repeats:
    """The steps above over one table with a column ``text``; ``close`` removes the stored texts."""

    def __init__(self, docs: DataFrame, size: int = SIZE, gram: int = GRAM):
        if gram > size:
            raise ValueError("an anchor must fit into a window")
        self.spark: SparkSession = reachable(docs.sparkSession)
        self.size, self.gram, self.span = size, gram, min(SPAN, max(2, size // 2))
        self.width = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        text = F.coalesce(F.col("text"), F.lit(""))
        self.keys = fresh(docs, "k1", "k2")
        self.keyed = docs.withColumns(dict(zip(self.keys, (F.xxhash64(text), F.xxhash64(F.lit("second"), text)))))
        self.tables: list[DataFrame] = []
        self.name = f"llm_texts_{uuid.uuid4().hex}"
        once = self.keyed.groupBy(F.col(self.keys[0]).alias("k1"), F.col(self.keys[1]).alias("k2")).agg(F.count("*").alias("copies"), F.first(text).alias("text"))
        # The aggregate deals by the same hash into as many parts as there are buckets: no second exchange.
        once.write.bucketBy(self.width, "k1", "k2").saveAsTable(self.name)

    def texts(self) -> DataFrame:
        return self.spark.read.table(self.name)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Written to the shared folder until ``clear``."""
        out = written(df, name)
        self.tables.append(out)
        return out

    def clear(self) -> None:
        """Remove the tables between the steps."""
        while self.tables:
            dropped(self.tables.pop())

    def close(self) -> None:
        self.clear()
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def anchor_rows(self) -> DataFrame:
        """k1, k2, anchor, first_start, last_start, gram: every anchor of every text."""
        size, gram = self.size, self.gram

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                k1, k2 = (c.to_numpy() for c in batch.columns[:2])
                for i, t in enumerate(batch.column(2)):
                    data = np.frombuffer(t.as_py().encode(), np.uint8)
                    at, first, last, h = anchors(data, size, gram)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), k1[i])),
                            pa.array(np.full(len(at), k2[i])),
                            pa.array(at.astype(np.int32)),
                            pa.array(first.astype(np.int32)),
                            pa.array(last.astype(np.int32)),
                            pa.array(h.view(np.int64)),
                        ],
                        ["k1", "k2", "anchor", "first_start", "last_start", "gram"],
                    )

        # Shorter texts have no window.
        rows = self.texts().where(F.octet_length("text") >= size).select("k1", "k2", "text")
        return rows.mapInArrow(run, "k1 long, k2 long, anchor int, first_start int, last_start int, gram long")

    def repeated_anchors(self) -> DataFrame:
        """k1, k2 and arrays of the anchors whose hash occurs twice or more."""
        rows = self.stored(self.anchor_rows(), "anchors")
        twice = self.stored(rows.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "grams")
        return self.by_text(rows.join(twice, "gram"), ["anchor", "first_start", "last_start", "gram"])

    def by_text(self, rows: DataFrame, fields: list[str]) -> DataFrame:
        """One row per text: its anchors or ranges in arrays, no longer than the text."""
        listed = rows.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("a"))
        return listed.select("k1", "k2", *(F.col(f"a.{f}").alias(f) for f in fields))

    def with_text(self, rows: DataFrame, how: str = "inner") -> DataFrame:
        """Rows per text beside the stored text; the texts stay in their buckets."""
        return self.texts().join(rows.hint("shuffle_hash"), ["k1", "k2"], how)

    def runs(self, chosen: DataFrame) -> DataFrame:
        """Sorted front-coded runs of the suffixes, in pieces, with the places each came from."""
        size = self.size

        def pieces(run_id: int, strings: list[bytes], places: list[tuple]) -> Iterator[pa.RecordBatch]:
            order = sorted(range(len(strings)), key=strings.__getitem__)
            distinct, entry = [], []
            for i in order:
                if not distinct or distinct[-1] != strings[i]:
                    distinct.append(strings[i])
                entry.append(len(distinct) - 1)
            at = 0
            for base in range(0, len(distinct), PIECE):
                some = distinct[base : base + PIECE]
                shared, lengths, rests = front_coded(some)
                end = bisect.bisect_left(entry, base + len(some))
                columns = list(zip(*(places[i] for i in order[at:end])))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([run_id], pa.int64()),
                        pa.array([base], pa.int64()),
                        pa.array([some[SAMPLE_EVERY // 2 :: SAMPLE_EVERY] or [some[len(some) // 2]]], pa.list_(pa.binary())),
                        pa.array([shared], pa.list_(pa.int32())),
                        pa.array([lengths], pa.list_(pa.int32())),
                        pa.array([rests], pa.binary()),
                        pa.array([entry[at:end]], pa.list_(pa.int32())),
                        *(pa.array([list(c)], pa.list_(k)) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()))),
                    ],
                    [f.split()[0] for f in _PIECES.replace("array<", "").replace(">", "").split(", ")],
                )
                at = end

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            strings: list[bytes] = []
            places: list[tuple] = []
            held, run_id = 0, None
            for batch in batches:
                keys = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
                lists = [batch.column(c).to_pylist() for c in ("first_start", "last_start", "anchor", "gram")]
                for i, t in enumerate(batch.column("text")):
                    data = t.as_py().encode()
                    for first, last, at, g in zip(*(x[i] for x in lists)):
                        # A run is named by where it begins.
                        run_id = hash((keys[0][i], keys[1][i], first)) if run_id is None else run_id
                        strings.append(data[first : last + size])
                        places.append((keys[0][i], keys[1][i], first, last, at, g))
                        held += last + size - first
                        if held > RUN_BYTES:
                            yield from pieces(run_id, strings, places)
                            strings, places, held, run_id = [], [], 0, None
            if strings:
                yield from pieces(run_id, strings, places)

        rows = self.with_text(chosen).select("k1", "k2", "text", "anchor", "first_start", "last_start", "gram")
        return rows.mapInArrow(run, _PIECES)

    def merge(self, runs: DataFrame) -> DataFrame:
        """run, entry, total, shared, lead: for each suffix of a run how many places have it in all runs, the
        longest prefix it shares with a neighbour in sorted order, and whether it leads its equals."""
        spark, width = self.spark, self.width
        # A bounded sample: some strings per partition, whatever the input's size.
        candidates = runs.select("run", "base", F.posexplode("samples").alias("i", "s"))
        drawn = candidates.orderBy(F.xxhash64("s", "run", "base", "i")).limit(SPLITTERS_SAMPLED * width)
        sample = sorted(bytes(r[0]) for r in drawn.select("s").collect())
        splitters = spark.sparkContext.broadcast(sorted({sample[len(sample) * k // width] for k in range(1, width)}) if sample else [])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                run_id, base, shared, lengths, rests, entries = (batch.column(c).to_pylist() for c in ("run", "base", "shared", "lengths", "rests", "entries"))
                for i in range(batch.num_rows):
                    strings = [s for s, _ in decoded(shared[i], lengths[i], rests[i])]
                    counts = np.bincount(np.array(entries[i]) - base[i], minlength=len(strings))
                    begin = 0
                    while begin < len(strings):
                        part = bisect.bisect_right(splitters.value, strings[begin])
                        end = bisect.bisect_left(strings, splitters.value[part]) if part < len(splitters.value) else len(strings)
                        coded = front_coded(strings[begin:end])
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([part], pa.int32()),
                                pa.array([run_id[i]], pa.int64()),
                                pa.array([base[i] + begin], pa.int64()),
                                pa.array([coded[0]], pa.list_(pa.int32())),
                                pa.array([coded[1]], pa.list_(pa.int32())),
                                pa.array([coded[2]], pa.binary()),
                                pa.array([counts[begin:end].tolist()], pa.list_(pa.int32())),
                            ],
                            ["part", "run", "base", "shared", "lengths", "rests", "counts"],
                        )
                        begin = end

        pieces = runs.mapInArrow(cut, "part int, run long, base long, shared array<int>, lengths array<int>, rests binary, counts array<int>")
        dealt = pieces.repartition(width, "part").sortWithinPartitions("part", "run", "base")

        def join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, held = None, {}
            for batch in batches:
                for row in batch.to_pylist():
                    if row["part"] != part:
                        yield from merge_part(held)
                        part, held = row["part"], {}
                    held.setdefault(row["run"], []).append(row)
            yield from merge_part(held)

        def stream(rows: list[dict]) -> Iterator[tuple[bytes, int]]:
            """A run from its pieces; the first string of a later piece is compared with the one before."""
            before = b""
            for row in rows:
                for j, (s, k) in enumerate(decoded(row["shared"], row["lengths"], row["rests"])):
                    yield s, k if j else common_prefix(before, s)
                    before = s

        def merge_part(held: dict[int, list[dict]]) -> Iterator[pa.RecordBatch]:
            if not held:
                return
            names = list(held)
            entries = [[(row["base"] + j, n) for row in held[r] for j, n in enumerate(row["counts"])] for r in names]
            place = [0] * len(names)
            out: list[list] = [[], [], [], [], []]
            group: list[tuple[int, int]] = []
            total, before_shared, length = 0, 0, -1

            def end_group(after: int) -> None:
                for j, (r, e) in enumerate(group):
                    for column, v in zip(out, (names[r], e, total, max(before_shared, after), j == 0)):
                        column.append(v)

            for s, k, r in merged([stream(held[x]) for x in names]):
                e, n = entries[r][place[r]]
                place[r] += 1
                if k == len(s) == length:
                    group.append((r, e))
                    total += n
                    continue
                end_group(k)
                group, total, before_shared, length = [(r, e)], n, k, len(s)
                if len(out[0]) > 50_000:
                    yield batch_of(out)
                    out = [[], [], [], [], []]
            end_group(0)
            yield batch_of(out)

        def batch_of(out: list[list]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["run", "entry", "total", "shared", "lead"])

        return dealt.mapInArrow(join_runs, "run long, entry long, total long, shared int, lead boolean")

    def group_hashes(self, chosen: DataFrame) -> DataFrame:
        """Two names for each group of ``span`` neighbouring windows of the chosen anchors: of what all its
        windows share (c1, c2) and of all its bytes (u1, u2). Groups begin at multiples of ``span`` from the
        anchor, so that equal windows are grouped alike; what they share doesn't depend on where the
        anchor's windows end, their bytes do."""
        size, span = self.size, self.span

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
                lists = [_array(batch.column(c), np.int64) for c in ("anchor", "first_start", "last_start", "alone")]
                for i, t in enumerate(batch.column("text")):
                    data = np.frombuffer(t.as_py().encode(), np.uint8)
                    at, first, last, alone = (x[i] for x in lists)
                    low, high = (first - at) // span, (last - at) // span
                    n = high - low + 1
                    which = np.repeat(np.arange(len(at)), n)
                    group = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[which]
                    nominal = group * span + at[which]
                    begin = np.maximum(nominal, first[which])
                    end = np.minimum(nominal + span - 1, last[which])
                    rolls = Rolling(data, 0), Rolling(data, 1)
                    # Place and length beside the anchor are part of a name.
                    marks = [x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for x in (group, (begin - at[which]) * 1024 + (end - begin))]
                    core = [r.at(nominal + span - 1, nominal + size) ^ marks[0] for r in rolls]
                    union = [r.at(begin, end + size) ^ marks[1] for r in rolls]
                    columns = [np.full(len(begin), k1[i]), np.full(len(begin), k2[i]), begin.astype(np.int32), end.astype(np.int32), alone[which].astype(bool)]
                    columns += [h.view(np.int64) for h in (*core, *union)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k1", "k2", "begin", "end", "alone", "c1", "c2", "u1", "u2"])

        rows = self.with_text(chosen).select("k1", "k2", "text", "anchor", "first_start", "last_start", "alone")
        return rows.mapInArrow(run, "k1 long, k2 long, begin int, end int, alone boolean, c1 long, c2 long, u1 long, u2 long")

    def window_hashes(self, ranges: DataFrame) -> DataFrame:
        """k1, k2, begin, h1, h2: every window that starts in the ranges (arrays begin, end) of a text."""
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
                begins, ends = (_array(batch.column(c), np.int64) for c in ("begin", "end"))
                for i, t in enumerate(batch.column("text")):
                    data = np.frombuffer(t.as_py().encode(), np.uint8)
                    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(begins[i], ends[i])])
                    hashes = [Rolling(data, w).at(starts, starts + size).view(np.int64) for w in (0, 1)]
                    columns = [np.full(len(starts), k1[i]), np.full(len(starts), k2[i]), starts.astype(np.int32), *hashes]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k1", "k2", "begin", "h1", "h2"])

        rows = self.with_text(ranges).select("k1", "k2", "text", "begin", "end")
        return rows.mapInArrow(run, "k1 long, k2 long, begin int, h1 long, h2 long")

    def repeated_windows(self) -> DataFrame:
        """k1, k2, begin, end: ranges of window starts whose windows start elsewhere too."""
        chosen = self.stored(self.repeated_anchors(), "chosen")
        runs = self.stored(self.runs(chosen), "runs")
        found = self.stored(self.merge(runs), "merged")
        fields = ["k1", "k2", "anchor", "first_start", "last_start", "gram"]
        places = runs.select("run", F.explode(F.arrays_zip("entries", *fields)).alias("p"))
        places = places.select("run", F.col("p.entries").cast("long").alias("entry"), *(f"p.{c}" for c in fields))
        judged = self.stored(places.join(found, ["run", "entry"]), "judged")
        whole = judged.where("total > 1").select("k1", "k2", F.col("first_start").alias("begin"), F.col("last_start").alias("end"))
        covered = F.least(F.col("last_start"), F.col("first_start") + F.col("shared") - self.size)
        part = judged.where((F.col("total") == 1) & (F.col("shared") >= self.size)).select("k1", "k2", F.col("first_start").alias("begin"), covered.alias("end"))

        # Suffixes not shared as a whole, and one of each set of equals that has the same anchor text.
        alone = judged.where("total = 1").select(*fields, F.lit(1).alias("alone"))
        open_grams = self.stored(alone.select("gram").distinct(), "open")
        partners = judged.where("total > 1 and lead").groupBy("run", "entry", "gram").agg(*(F.first(c).alias(c) for c in fields[:-1]))
        partners = partners.join(open_grams, "gram", "left_semi").select(*fields, F.lit(0).alias("alone"))
        asked = self.by_text(alone.unionByName(partners), ["anchor", "first_start", "last_start", "alone"])
        groups = self.stored(self.group_hashes(asked), "groups")
        # Equal groups are one from here on, with a place to read them at.
        names = ["c1", "c2", "u1", "u2"]
        place = ["k1", "k2", "begin", "end"]
        distinct = self.stored(groups.groupBy(*names).agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in place)), "distinct")
        same = groups.where("alone").select(*place, *names).join(distinct.where("n > 1").select(*names), names).select(*place)
        # Windows that share their core with others that aren't the same group.
        several = self.stored(distinct.groupBy("c1", "c2").agg(F.count("*").alias("m")).where("m > 1").select("c1", "c2"), "several")
        mixed = distinct.join(several, ["c1", "c2"]).select(*place)
        windows = self.stored(self.window_hashes(self.by_text(mixed, ["begin", "end"])), "windows")
        again = self.stored(windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2"), "again")
        ones = windows.join(again, ["h1", "h2"]).select("k1", "k2", "begin", F.col("begin").alias("end"))
        return whole.unionByName(part).unionByName(same).unionByName(ones)

    def spans(self) -> DataFrame:
        """k1, k2, spans: per text with any, the maximal runs of bytes to remove, as begin and end."""
        ranges = self.repeated_windows().groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("ranges"))
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for ranges in batch.column(2).to_pylist():
                    spans: list[list[int]] = []
                    for r in ranges:
                        begin, end = r["begin"], r["end"] + size
                        if spans and begin <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], end)
                        else:
                            spans.append([begin, end])
                    out.append([{"begin": a, "end": b} for a, b in spans])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))],
                    ["k1", "k2", "spans"],
                )

        return ranges.mapInArrow(run, "k1 long, k2 long, spans array<struct<begin: int, end: int>>")


    def kept(self, digest_only: bool, words: int = 0, sure: int = 0) -> DataFrame:
        """k1, k2, n_bytes, n_removed, n_spans and kept_sha256 of every text; or, of the texts that lose
        bytes, also the spans and the kept bytes. ``words`` and ``sure`` choose spans by ``chosen_spans``.
        Written, after which the stored texts are removed."""
        size = self.size
        spans = written(self.spans(), "spans")
        self.clear()
        kind = "k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        if not digest_only:
            kind += ", spans array<struct<begin: int, end: int>>, kept binary"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                copies = batch.column(2).to_pylist()
                lists = batch.column(4).to_pylist()
                columns: list[list] = [[] for _ in range(8)]
                for i, t in enumerate(batch.column(3)):
                    data = t.as_py().encode()
                    out = [(s["begin"], s["end"]) for s in lists[i] or []]
                    if copies[i] > 1 and len(data) >= size:
                        out = [(0, len(data))]
                    if words:
                        out = chosen_spans(data, out, words, sure)
                    if not out and not digest_only:
                        continue
                    rest = without(data, out)
                    values = keys[0][i], keys[1][i], len(data), len(data) - len(rest), len(out), hashlib.sha256(rest).hexdigest(), [{"begin": a, "end": b} for a, b in out], rest
                    for c, v in zip(columns, values):
                        c.append(v)
                kinds = (*(pa.int64(),) * 5, pa.string(), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])), pa.binary())
                names = ["k1", "k2", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
                n = 6 if digest_only else 8
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:n], kinds)], names[:n])

        done = self.with_text(spans, "left").select("k1", "k2", "copies", "text", "spans").mapInArrow(run, kind)
        done = written(done, "kept")
        self.close()
        return done


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The bytes outside the spans."""
    left, at = [], 0
    for a, b in spans:
        left.append(data[at:a])
        at = b
    left.append(data[at:])
    return b"".join(left)


def chosen_spans(data: bytes, spans: list[tuple[int, int]], words: int, sure: int) -> list[tuple[int, int]]:
    """Spans of ``sure`` bytes or more, and shorter ones of more than ``words`` words (a cut word counts).

    A text that would be left with no more than ``words`` words is a copy of the passage and not a text that
    holds it, so it loses no shorter ones: cut from all copies, their text would be lost.
    """
    long = [s for s in spans if s[1] - s[0] >= sure]
    out = [(a, b) for a, b in spans if b - a >= sure or len(data[a:b].split()) > words]
    return out if len(out) == len(long) or len(without(data, out).split()) > words else long


def digests(docs: DataFrame, size: int = SIZE, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Texts are UTF-8 bytes, a null text is empty; matches never cross texts and are judged on the input.
    A text shorter than ``size`` keeps everything, one that another row repeats loses everything if it is
    that long. Repeated rows give repeated rows, an empty table an empty one; other columns are not read.
    """
    found = Repeats(id_text(docs, id_col, text_col), size, gram)
    done = found.kept(digest_only=True)
    rows = found.keyed.select("doc_id", F.col(found.keys[0]).alias("k1"), F.col(found.keys[1]).alias("k2"))
    return rows.join(done, ["k1", "k2"]).drop("k1", "k2")


def deduplicated(docs: DataFrame, size: int = SIZE, gram: int = GRAM, words: int = 0, sure: int = SIZE) -> DataFrame:
    """All rows and columns, the repeated passages cut out of ``text``; ``n_chars`` follows if there is one.

    With ``words``, of the runs of repeated bytes those of ``sure`` bytes are cut, and shorter ones of more than
    so many words from texts that keep more than so many.
    A character of which a cut leaves only some bytes goes too. Texts without repeats stay as they are,
    null texts included.
    """
    found = Repeats(docs, size, gram)
    done = found.kept(digest_only=False, words=words, sure=sure)
    kept = fresh(found.keyed, "kept")[0]
    done = done.select(*(F.col(own).alias(name) for own, name in zip(("k1", "k2"), found.keys)), F.col("kept").alias(kept))
    joined = found.keyed.join(done, found.keys, "left")
    # A whole character: what is no UTF-8 after the cut is a leading or a trailing part of one.
    new = F.coalesce(whole_characters(kept), F.col("text"))
    out = joined.withColumn("text", new)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(kept).isNotNull(), F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def whole_characters(column: str) -> Column:
    """Bytes as text, without the parts of characters that cuts left over."""

    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else bytes(v).decode("utf-8", "ignore"))

    return decode(F.col(column))

"""Join of many records to one row per key, safe for a key that holds a third of the records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecat.session import stage

# A key is hot if it has more records than this, and more than this part of them all.
HOT_RECORDS = 100_000
HOT_PART = 64


def one_per_key(df: DataFrame, key: str, prefer: Column) -> DataFrame:
    """One row per key: the one with the greatest ``prefer``. Copies shrink before the shuffle."""
    kept = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*kept), prefer).alias("r")).select(key, "r.*")


def lookup_join(records: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join to a side with one row per key.

    Adaptive execution splits a hot key only where a sort-merge join reads two plain shuffles. A
    lookup made by an aggregate is already partitioned by its key and would skip its own, so the
    join also names the key's hash: that shuffles the (narrow) lookup once more and lets a hot key
    of the records be split at run time. A small lookup still becomes a broadcast by its measured
    size.
    """
    left = records.withColumn("_key_hash", F.xxhash64(key))
    right = lookup.withColumn("_key_hash", F.xxhash64(key))
    return left.join(right, [key, "_key_hash"], "left").drop("_key_hash")


def has_hot_key(records: DataFrame, key: str) -> bool:
    """Whether a key has too many records for one task to join. Counts them at once, by the key's hash alone."""
    counts = records.groupBy(F.xxhash64(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    seen = counts.agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    return (seen["most"] or 0) > max(HOT_RECORDS, (seen["total"] or 0) // HOT_PART)


def grouped_lookup_join(
    records: DataFrame, rows: DataFrame, key: str, group: Callable[[DataFrame, list[str]], DataFrame]
) -> DataFrame:
    """Left join of records to ``group(rows, by)``, one row per key made of many wide rows, which move once.

    The rows go where the records of their key go, so neither the aggregates nor the join shuffle them again.
    On the way they meet the records' keys, each once, in a join of two plain shuffles: a key that holds many
    rows is split there at run time, and only then do the aggregates shuffle, what is left of its parts. The
    hint spares the rows a sort. A hot key of the records can't be split like this; ``lookup_join`` can.
    """
    if has_hot_key(records, key):
        return lookup_join(records, group(rows, [key]), key)
    by = [key, "_key_hash"]
    keys = records.select(key).distinct().withColumn("_key_hash", F.xxhash64(key))
    met = rows.withColumn("_key_hash", F.xxhash64(key)).join(keys.hint("shuffle_hash"), by)
    return records.withColumn("_key_hash", F.xxhash64(key)).join(group(met, by), by, "left").drop("_key_hash")


def rank_expr(merit: Column, *tie: Column) -> Column:
    """One number that orders copies of a page: by merit (at most 2^45), equal ones by their content.

    A decimal has a fixed size, so copies are compared by a hash aggregate, which need not sort them.
    """
    apart = F.xxhash64(*tie).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    return (merit.cast("decimal(14,0)") * F.lit(str(1 << 64)).cast("decimal(20,0)") + apart).cast("decimal(38,0)")


def best_lookup(records: DataFrame, facts: DataFrame, key: str, rank: Column) -> DataFrame:
    """Left join of records to the copy of each key's facts with the greatest ``rank`` (``rank_expr``).

    Facts are wide, so they are written once and shuffled once, to the records of the copy that won:
    copies of a key are told apart by (key, rank, row number) alone, which shrink before their shuffle, and
    the winner's number goes to the records by ``lookup_join``. A key that holds a third of the records, and
    records without any facts, are split at run time or spread by hash.
    """
    numbered = stage(facts.withColumns({"_rank": rank, "_row": F.monotonically_increasing_id()}), "facts")
    best = numbered.groupBy(key).agg(F.max_by("_row", "_rank").alias("_row"))
    none = -1 - F.pmod(F.xxhash64(*records.columns), F.lit(1 << 20))
    placed = lookup_join(records, best, key).withColumn("_row", F.coalesce("_row", none))
    return placed.join(numbered.drop(key, "_rank"), "_row", "left").drop("_row")

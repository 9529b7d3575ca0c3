"""Benchmark decontamination with DataFrame functions only.

Windows of documents that are as long as a benchmark item and begin at a shingle of an item of that
length get a SimHash. A multi-index over blocks of its bits finds every item of the same length within
the Hamming radius (at least one of the blocks differs by no more than its share of the radius). The
similarity of word shingles, weighted by how often they occur, then verifies each pair exactly.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecat.llm.common import written

SHINGLE = 5
SIMILAR = 0.8
BLOCKS = 8
BLOCK_BITS = 8
# Within this many differing bits every item is found: 8 blocks, so one differs in at most 2 bits.
RADIUS = 23
NEAR = RADIUS // BLOCKS
# Shingles of items that one pass over the documents holds in a broadcast (16 bytes each).
SHINGLES_PER_PASS = 1_000_000


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: str) -> Column:
    """Hash of each run of five words of the column; fewer words are one shingle, none have none."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(SHINGLE))
    return F.expr(
        f"case when size({words}) >= {SHINGLE} then transform(sequence(0, size({words}) - {SHINGLE}), i -> xxhash64({parts}))"
        f" when size({words}) > 0 then array(xxhash64(array_join({words}, ' ')))"
        f" else cast(array() as array<bigint>) end"
    )


def shingles(words: str) -> Column:
    """The shingles themselves."""
    return F.expr(
        f"case when size({words}) >= {SHINGLE} then transform(sequence(1, size({words}) - {SHINGLE - 1}), i -> array_join(slice({words}, i, {SHINGLE}), ' '))"
        f" when size({words}) > 0 then array(array_join({words}, ' ')) else cast(array() as array<string>) end"
    )


def simhash(hashes: str) -> Column:
    """64 bits, each 1 where it is set in over half of the hashes."""
    return F.expr(
        f"aggregate(transform(sequence(0, 63), b -> aggregate({hashes}, 0, (n, h) -> n + cast(shiftright(h, b) & 1L as int))),"
        f" named_struct('fp', 0L, 'bit', 0),"
        f" (s, n) -> named_struct('fp', s.fp | case when 2 * n > size({hashes}) then shiftleft(1L, s.bit) else 0L end, 'bit', s.bit + 1),"
        f" s -> s.fp)"
    )


def similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays of shingles: a shingle weighs as often as it occurs.

    Where one array has no repeat, each shared shingle weighs one, and the arrays meet by hash.
    """
    plain = f"size(array_distinct({a})) = size({a}) or size(array_distinct({b})) = size({b})"
    counted = f"aggregate(array_distinct({a}), 0, (n, x) -> n + least(size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x))))"
    both = F.expr(f"case when {plain} then size(array_intersect({a}, {b})) else {counted} end")
    return both / (F.size(a) + F.size(b) - both).cast("double")


def block_keys(fp: Column, near: int) -> Column:
    """Block number and value of each block of the bits, and all values within ``near`` bits of it."""
    masks = [sum(1 << b for b in c) for n in range(near + 1) for c in combinations(range(BLOCK_BITS), n)]
    values = [
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fp, k * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("value"))
        for k in range(BLOCKS)
    ]
    if not near:
        return F.array(*values)
    return F.flatten(
        F.transform(
            F.array(*values),
            lambda v: F.transform(
                F.array(*map(F.lit, masks)),
                lambda m: F.struct(v["block"].alias("block"), v["value"].bitwiseXOR(m.cast("long")).alias("value")),
            ),
        )
    )


def item_windows(docs: DataFrame, items: DataFrame, passes: int) -> DataFrame:
    """doc_id, text_hash, m, k1, k2, words: windows of item length that begin at a shingle of such an item."""
    text = F.col("text")
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), words_of(text).alias("words"))
    rows = rows.withColumn("hashes", shingle_hashes("words"))
    # The outer form, as Spark would else test the arrays' sizes first, and work out the words again for it.
    spread = rows.select("doc_id", "text_hash", "words", "hashes", F.posexplode_outer("hashes").alias("at", "h"))
    found = []
    for k in range(passes):
        some = items.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k)
        keys = some.select("m", "n", F.explode("hashes").alias("h")).distinct()
        hit = spread.join(F.broadcast(keys), "h")  # size checked by the caller
        start = F.greatest(F.lit(0), F.least(F.col("at"), F.size("hashes") - F.col("m")))
        found.append(hit.select("doc_id", "text_hash", "m", F.slice("words", start + 1, F.col("n")).alias("words")))
    return reduce(DataFrame.unionByName, found).withColumns({"k1": F.xxhash64("words"), "k2": F.hash("words")})


def leaks(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """found_id, found_hash (of the text), items (ids, ascending), best (similarity): the contaminated (doc_id, text).

    A null or empty text is clean, an item without a word matches nothing, an item of fewer than five words
    matches only a whole text of the same words. Repeated rows are one row here.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), words_of(F.col(item_text_col).cast("string")).alias("words"))
    items = items.where(F.size("words") > 0).distinct().withColumn("hashes", shingle_hashes("words"))
    items = written(items.select("item_id", "words", "hashes", F.size("hashes").alias("m"), F.size("words").alias("n")), "items")
    total = items.agg(F.sum("m")).first()[0] or 0
    passes = max(1, -(-total // SHINGLES_PER_PASS))

    windows = written(item_windows(docs, items, passes), "windows")
    # Copies of a passage are one window from here on.
    once = windows.groupBy("m", "k1", "k2").agg(F.first("words").alias("words"))
    prints = once.withColumn("hashes", shingle_hashes("words")).withColumn("fp", simhash("hashes"))
    prints = written(prints.select("m", "k1", "k2", "words", "fp"), "prints")
    # The index has hundreds of rows per item, so it holds no words, and is shuffled like the windows: Spark
    # would take it for as small as the items.
    index = items.select("item_id", "m", simhash("hashes").alias("item_fp"))
    index = index.select("item_id", "m", "item_fp", F.inline(block_keys(F.col("item_fp"), NEAR)))
    asked = prints.select("m", "k1", "k2", "fp", F.inline(block_keys(F.col("fp"), 0)))
    close = asked.join(index.hint("merge"), ["m", "block", "value"])
    close = close.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS).select("m", "k1", "k2", "item_id").distinct()
    pairs = close.join(prints.select("m", "k1", "k2", "words"), ["m", "k1", "k2"])
    pairs = pairs.join(items.select("item_id", "m", F.col("words").alias("item_words")), ["item_id", "m"])
    pairs = pairs.select("m", "k1", "k2", "item_id", shingles("words").alias("a"), shingles("item_words").alias("b"))
    verified = pairs.withColumn("similarity", similarity("a", "b")).where(F.col("similarity") >= SIMILAR)
    verified = written(verified.select("m", "k1", "k2", "item_id", "similarity"), "verified")

    return (
        windows.join(verified, ["m", "k1", "k2"])
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(F.max("similarity").alias("similarity"))
        .groupBy(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"))
        .agg(F.sort_array(F.collect_list("item_id")).alias("items"), F.max("similarity").alias("best"))
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """doc_id, contaminated, n_items, items (ids, ascending), similarity (the best, 0 if none) of every row.

    Repeated rows give repeated rows, an empty table an empty one; without items all is clean. Other columns
    are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = leaks(docs, benchmark, item_col, item_text_col)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    out = rows.join(marked, rows["doc_id"].eqNullSafe(marked["found_id"]) & (rows["text_hash"] == marked["found_hash"]), "left")
    none = F.array().cast("array<bigint>")
    return out.select(
        "doc_id",
        F.col("found_hash").isNotNull().alias("contaminated"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("best", F.lit(0.0)).alias("similarity"),
    )


def cleaned(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of the rows that hold no benchmark item."""
    marked = leaks(docs, benchmark)
    same = F.col("doc_id").cast("long").eqNullSafe(marked["found_id"]) & (F.xxhash64(F.col("text").cast("string")) == marked["found_hash"])
    return docs.join(marked, same, "left_anti")

"""Quality rules with adaptive thresholds.

Measures of every text, then quantile sketches of the measures per language and source (KLL sketches,
built in the tasks and merged by Spark), merged again to languages and to the whole corpus. A group's
thresholds come from its own sketch, or from the next wider one while the group is small. The verdict
joins the thresholds back to the measures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecat.llm.common import by_bytes, written

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
# Measure: distance of the upper and of the lower threshold from the median where a group has no spread on that
# side (None: no such threshold).
MARGINS: dict[str, tuple[float | None, float | None]] = {
    "word_length": (1.5, 1.5),
    "symbol_share": (0.1, None),
    "dup_line_share": (0.05, None),
    "repeat_share": (0.05, None),
}
# Tail of each measure, how many times as far from the median as its quantile the threshold lies, and the least
# distance. Up to a tail of unusual rows does not move a threshold, so measures of junk, which can fill a source,
# take a wide one: six times the distance of the 15 % quantile is about six standard deviations of a bell curve.
# The shares of repeats end at a quantile itself, and would reject ordinary rows without a least distance.
SPREAD = 6.0
TAILS: dict[str, tuple[float, float, float]] = {
    "word_length": (0.15, SPREAD, 0.0),
    "symbol_share": (0.15, SPREAD, 0.0),
    "dup_line_share": (0.01, 1.0, 0.05),
    "repeat_share": (0.01, 1.0, 0.05),
}
# Rows a group needs before its own sketch is used.
LEAST_ROWS = 200


def measures(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of one text."""
    words = text.encode().split() if text else []
    if not words:
        return 0, 0, sum(map((text or "").count, SYMBOLS)), 0, 0, 0
    chars = len(text) - sum(map(text.count, SPACE))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
    repeated = 0
    if len(w) > 3:
        pair = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]
        _, which, n = np.unique(pair[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
        window = n[which] > 1
        covered = np.zeros(len(w), bool)
        for k in range(3):
            covered[k : len(w) - 2 + k] |= window
        repeated = int(covered.sum())
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source (null: empty) and the counts of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(keys: list, texts: list) -> pa.RecordBatch:
            rows = np.array([measures(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k["doc_id"] for k in keys], pa.int64()),
                    pa.array([k["lang"] for k in keys], pa.string()),
                    pa.array([k["source"] for k in keys], pa.string()),
                    *(pa.array(c, pa.int64()) for c in rows.T),
                ],
                ["doc_id", "lang", "source", *COUNTS],
            )

        return by_bytes(batches, work)

    key = F.struct(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
    )
    rows = docs.select(key.alias("key"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(run, schema)


def with_shares(rows: DataFrame) -> DataFrame:
    """The measures that have thresholds, and whether the fixed base rules fail."""
    n = F.col("n_words")

    def share(x: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.col(x) / F.col(of)).otherwise(0.0)

    return rows.withColumns(
        {
            "word_length": share("word_chars", "n_words"),
            "symbol_share": share("n_symbols", "n_words"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "base_failed": (n < 50) | (100 * F.col("n_repeat_words") > 50 * n),
        }
    )


def thresholds(rows: DataFrame) -> DataFrame:
    """lang, source, and low and high threshold of each measure, from all rows that pass the base rules."""
    names = list(MARGINS)
    passed = rows.where(~F.col("base_failed"))
    group = passed.groupBy("lang", "source").agg(F.count("*").alias("n"), *(F.kll_sketch_agg_double(m).alias(m) for m in names))
    lang = group.groupBy("lang").agg(F.sum("n").alias("lang_n"), *(F.kll_merge_agg_double(m).alias(f"lang_{m}") for m in names))
    every = lang.agg(*(F.kll_merge_agg_double(f"lang_{m}").alias(f"all_{m}") for m in names))

    # One row per group and one row for all: joined by the plain key, then by a constant one-row table.
    joined = group.join(lang, "lang").crossJoin(every)
    sketch = {
        m: F.when(F.col("n") >= LEAST_ROWS, F.col(m)).when(F.col("lang_n") >= LEAST_ROWS, F.col(f"lang_{m}")).otherwise(F.col(f"all_{m}"))
        for m in names
    }
    chosen = joined.select("lang", "source", *(s.alias(m) for m, s in sketch.items()))
    quantiles = chosen.select("lang", "source", *(F.kll_sketch_get_quantile_double(m, F.lit(q)).alias(f"{m}_{k}") for m in names for k, q in (("a", TAILS[m][0]), ("b", 0.5), ("c", 1 - TAILS[m][0]))))

    def distance(m: str, spread: Column, margin: float) -> Column:
        _, times, least = TAILS[m]
        return F.when(spread > 0, F.greatest(times * spread, F.lit(least))).otherwise(margin)

    out = ["lang", "source"]
    for m, (up, down) in MARGINS.items():
        a, b, c = (F.col(f"{m}_{k}") for k in "abc")
        if up is not None:
            out.append((b + distance(m, c - b, up)).alias(f"{m}_high"))
        if down is not None:
            out.append((b - distance(m, b - a, down)).alias(f"{m}_low"))
    return quantiles.select(*out)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, the counts, base_failed, kept and the reasons of every row.

    A null or empty text has no words and fails the base rules. A null language or source is a group of
    its own. A measure that equals its threshold passes. Very long texts are measured whole, and columns of
    ``docs`` beside the four named play no part, whatever their names. Repeated rows give repeated rows, an
    empty table an empty one.
    """
    rows = written(with_shares(measured(docs, id_col, text_col, lang_col, source_col)), "measures")
    limits = written(thresholds(rows), "thresholds")
    tests = []
    for m, (up, down) in MARGINS.items():
        if up is not None:
            tests.append(F.when(F.col(m) > F.col(f"{m}_high"), F.lit(f"{m}_high")))
        if down is not None:
            tests.append(F.when(F.col(m) < F.col(f"{m}_low"), F.lit(f"{m}_low")))
    reasons = F.filter(F.array(F.when(F.col("base_failed"), F.lit("base")), *tests), lambda x: x.isNotNull())
    joined = rows.join(limits, ["lang", "source"], "left").withColumn("reasons", reasons)
    return joined.select("doc_id", *COUNTS[:5], "base_failed", (F.size("reasons") == 0).alias("kept"), "reasons", "lang", "source")

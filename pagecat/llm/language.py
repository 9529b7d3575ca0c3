"""Language ID by mixture inference.

Every language is a distribution over hashed character bigrams and trigrams, counted over all training
rows. A document is a mixture of languages: expectation-maximisation estimates the proportions from the
n-gram likelihoods, and the set of languages is the one with the best penalised likelihood (backward
elimination; half the logarithm of the sample size per language).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pagecat.llm.common import fresh, id_text

BUCKETS = 1 << 13
UNKNOWN = "und"
# Overlapping n-grams repeat each character's evidence about this often.
OVERLAP = 5.0
MOST_LANGUAGES = 1000


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed character bigrams and trigrams of the words; None without a letter."""
    if not text:
        return None
    c = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letter_table()[c]
    if not letter.any():
        return None
    # One space for each run of other characters.
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[:-1] |= letter[1:]
    c = np.where(letter, c, np.uint32(32))[kept].astype(np.uint64)
    twice = np.flatnonzero((c[1:] == 32) & (c[:-1] == 32))
    if len(twice):
        c = np.delete(c, twice)
    pair = c[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = pair[:-1] * np.uint64(0xFF51AFD7ED558CCD) + c[2:] * np.uint64(0x165667B19E3779F9)
    both = np.concatenate([pair, three])
    both ^= both >> np.uint64(29)
    both *= np.uint64(0xBF58476D1CE4E5B9)
    return np.bincount((both >> np.uint64(51)).view(np.int64), minlength=BUCKETS)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, and per language the n-gram probabilities, from every row given.

    Counted inside the tasks and summed by Spark; the driver gets one number per language and bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                counts = gram_counts(t.as_py())
                if counts is not None:
                    if lang in sums:
                        sums[lang] += counts
                    else:
                        sums[lang] = counts.astype(np.int64)
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                ["lang", "bucket", "n"],
            )

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    )
    summed = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = (
        summed.groupBy("lang")
        .agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("ns"))
        .limit(MOST_LANGUAGES + 1)
        .collect()
    )
    if len(got) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: the model would not stay small")
    got.sort(key=lambda r: r["lang"])
    model = np.full((len(got), BUCKETS), 0.5)
    for row, r in zip(model, got):
        row[np.array(r["buckets"], np.int64)] += np.array(r["ns"], np.float64)
    return [r["lang"] for r in got], model / model.sum(axis=1, keepdims=True) if len(got) else model


def _fit(p: np.ndarray, n: np.ndarray, steps: int = 25) -> tuple[np.ndarray, float]:
    """Mixture weights of the columns of p for observations counted n; the log-likelihood."""
    w = np.full(p.shape[1], 1 / p.shape[1])
    total = n.sum()
    if len(w) > 1:
        for _ in range(steps):
            new = w * ((n / (p @ w)) @ p) / total
            done = np.abs(new - w).max() < 1e-3
            w = new
            if done:
                break
    return w, float(n @ np.log(p @ w))


def mixture(counts: np.ndarray, model: np.ndarray) -> list[tuple[int, float]]:
    """Languages of one document with their proportions, largest first; model: a column per language."""
    at = np.flatnonzero(counts != 0)
    n = counts[at].astype(np.float64)
    p = model[at]
    price = 0.5 * np.log(max(n.sum() / OVERLAP, 2.0)) * OVERLAP
    kept = list(range(model.shape[1]))
    w, value = _fit(p, n)
    while len(kept) > 1:
        small = w < max(0.01, 0.2 * w.max()) if len(kept) > 2 else np.arange(len(w)) == w.argmin()
        small[w.argmax()] = False
        if not small.any():
            small[w.argmin()] = True
        fewer = [k for k, s in zip(kept, small) if not s]
        w2, value2 = _fit(p[:, fewer], n)
        if value2 + price * (len(kept) - len(fewer)) < value:
            if small.sum() == 1:
                break
            fewer = [k for k, x in zip(kept, w) if x > w.min()]
            w2, value2 = _fit(p[:, fewer], n)
            if value2 + price * (len(kept) - len(fewer)) < value:
                break
        kept, w, value = fewer, w2, value2
    return sorted(zip(kept, w.tolist()), key=lambda x: -x[1])


FOUND = "lang_pred string, score double, languages array<string>, proportions array<double>"


def annotated(docs: DataFrame, trained: tuple[list[str], np.ndarray], text_col: str = "text", column: str | None = None) -> DataFrame:
    """All rows and columns, and a last one, ``column`` or else a name no other has, with what FOUND names, in one pass and without a join.

    A text that is null, empty or without a letter is ``und`` with score 0, as is every text if there was
    nothing to learn from.
    """
    column = column or fresh(docs, "language")[0]
    shared = docs.sparkSession.sparkContext.broadcast(trained)
    at = docs.columns.index(text_col)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.string())), ("proportions", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, by_language = shared.value
        probabilities = np.ascontiguousarray(by_language.T)
        for batch in batches:
            out = []
            for t in batch.column(at):
                counts = gram_counts(t.as_py()) if names else None
                found = [] if counts is None else mixture(counts, probabilities)
                out.append(
                    {
                        "lang_pred": names[found[0][0]] if found else UNKNOWN,
                        "score": min(1.0, found[0][1]) if found else 0.0,
                        "languages": [names[k] for k, _ in found],
                        "proportions": [w for _, w in found],
                    }
                )
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], [*batch.schema.names, column])

    schema = StructType([*docs.schema.fields, StructField(column, StructType.fromDDL(FOUND))])
    return docs.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def detect(
    docs: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """doc_id, lang_pred, score (share of that language), languages and proportions of every row.

    Learns from the rows where ``train_on`` holds and the language is given. Repeated rows give repeated
    rows, an empty table an empty one; other columns are not read.
    """
    trained = train(docs.where(train_on), text_col, lang_col)
    return annotated(id_text(docs, id_col, text_col), trained).select("doc_id", "llm_language.*")

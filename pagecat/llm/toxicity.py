"""Toxicity: significant maximal-scoring segments of token log-odds.

Tokens of a word are the word itself and its first three, four and five characters. Their log-odds
between toxic and other training texts have an informative Dirichlet prior (the corpus's own
proportions); a log-odds counts only as far as it exceeds Z of its standard deviations, and every word
costs DRIFT, so that neutral prose scores below zero. One linear scan finds all maximal-scoring segments
of a text. A segment's score has an extreme-value tail with the rate that solves sum(p e^(rate s)) = 1
over the words of texts that aren't toxic, which gives each segment an expected number of chance
occurrences in a text of that length; the sum over significant segments is the evidence, and a
logistic curve over training rows turns it into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecat.llm.common import by_bytes, written

WORDS = re.compile(r"[^\W_]+")
PREFIXES = (3, 4, 5)
Z = 2.5
DRIFT = 0.5
PRIOR = 50.0
# Chance occurrences a significant segment may have in its text.
SIGNIFICANT = 0.1
# Labels the fit takes at most (16 bytes each in a broadcast). They and Z bound the tokens that are scored.
MOST_LABELS = 1_000_000
BINS = 400
HIGHEST = 100.0


def tokens_of(word: str) -> list[str]:
    """A word, and its leading characters where it is longer (marked with an asterisk)."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


def part_tokens(part: str, known: dict[str, tuple[str, ...]]) -> tuple[str, ...]:
    """Tokens of all words of a part between white space."""
    out = tuple(t for w in WORDS.findall(part) for t in tokens_of(w))
    if len(part) <= 40:
        if len(known) > 100_000:
            known.clear()
        known[part] = out
    return out


def token_tallies(rows: DataFrame) -> DataFrame:
    """token, toxic, other: texts that hold the token, over all rows of (text, toxic), counted in the tasks first.

    Texts rather than occurrences, as one text may repeat a word hundreds of times.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: tuple[Counter, Counter] = (Counter(), Counter())
        known: dict[str, tuple[str, ...]] = {}

        def flush() -> pa.RecordBatch:
            keys = list(sides[0] | sides[1])
            batch = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([sides[1][k] for k in keys], pa.int64()), pa.array([sides[0][k] for k in keys], pa.int64())],
                ["token", "toxic", "other"],
            )
            sides[0].clear()
            sides[1].clear()
            return batch

        for batch in batches:
            for t, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                found: set[str] = set()
                for part in set(t.as_py().lower().split()):
                    found.update(known.get(part) or part_tokens(part, known))
                sides[toxic].update(found)
                if len(sides[0]) + len(sides[1]) > 400_000:
                    yield flush()
        yield flush()

    return rows.mapInArrow(run, "token string, toxic long, other long").groupBy("token").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")
    )


def token_scores(tallies: DataFrame) -> DataFrame:
    """token, score, least: log-odds beyond Z standard deviations; only tokens that have any."""
    totals = tallies.where(~F.col("token").endswith("*")).agg(F.sum("toxic").alias("all_toxic"), F.sum("other").alias("all_other"))
    every = F.col("all_toxic") + F.col("all_other")
    prior = F.lit(PRIOR) * (F.col("toxic") + F.col("other")) / every + F.lit(0.5)

    def side(n: str, total: str) -> Column:
        return F.log((F.col(n) + F.col("prior")) / (F.col(total) + F.lit(PRIOR) - F.col(n) - F.col("prior") + F.lit(1.0)))

    odds = (
        tallies.crossJoin(F.broadcast(totals))  # one row
        .withColumn("prior", prior)
        .withColumn("delta", side("toxic", "all_toxic") - side("other", "all_other"))
        .withColumn("deviation", F.sqrt(1 / (F.col("toxic") + F.col("prior")) + 1 / (F.col("other") + F.col("prior"))))
    )
    sure = F.signum("delta") * F.greatest(F.abs("delta") - Z * F.col("deviation"), F.lit(0.0))
    return odds.withColumn("score", sure).where("score <> 0 and isnotnull(score)").select("token", "score")


@dataclass
class Model:
    """What the scoring of a text needs; a few numbers and the tokens that tell."""

    tokens: dict[str, float]
    rate: float
    slope: float
    offset: float

    def part_scores(self, part: str, known: dict[str, tuple[float, ...]]) -> tuple[float, ...]:
        """For each word of a part between white space: the token that says most, less a word's cost."""
        out = tuple(max((self.tokens.get(t, 0.0) for t in tokens_of(w)), key=abs) - DRIFT for w in WORDS.findall(part))
        if len(part) <= 40:
            if len(known) > 300_000:
                known.clear()
            known[part] = out
        return out

    def scores(self, text: str | None, known: dict[str, tuple[float, ...]]) -> list[float]:
        """Scores of the words of a text in order."""
        out: list[float] = []
        for part in text.lower().split() if text else ():
            out += known.get(part) or self.part_scores(part, known)
        return out

    def evidence(self, text: str | None, known: dict[str, tuple[float, ...]]) -> tuple[float, list[tuple[int, int, float]]]:
        """Sum over significant segments of minus the log of their chance occurrences; the segments."""
        s = np.array(self.scores(text, known))
        if not len(s) or s.max() <= 0:
            return 0.0, []
        size = math.log(len(s))
        found = [(a, b, self.rate * score - size) for a, b, score in maximal_segments(s)]
        found = [x for x in found if x[2] >= -math.log(SIGNIFICANT)]
        return sum(x[2] for x in found), found

    def probability(self, evidence: float) -> float:
        x = max(-60.0, min(60.0, self.slope * min(evidence, HIGHEST) + self.offset))
        return 1 / (1 + math.exp(-x))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments [begin, end) with their scores, in linear time.

    Only positive scores can begin one, so runs of others are skipped over by their sum.
    """
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[list] = []  # begin, end, total before, total after, nearest entry with a smaller total before
    for i in np.flatnonzero(scores > 0).tolist():
        begin, end, before, after = i, i + 1, total[i], total[i + 1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= after:
                stack.append([begin, end, before, after, j])
                break
            begin, before = stack[j][0], stack[j][2]
            del stack[j:]
    return [(b, e, float(y - x)) for b, e, x, y, _ in stack]


def _rate(background: dict[float, float], toxic: dict[float, float]) -> float:
    """The positive solution of sum(p e^(rate s)) = 1 for word scores of other texts.

    A millionth of the toxic texts' distribution is mixed in, so that scores never seen elsewhere
    count as rare, not as impossible.
    """
    mixed: Counter = Counter()
    for share, counts in ((1.0, background), (1e-6, toxic)):
        n = sum(counts.values())
        for s, k in counts.items():
            mixed[s] += share * k / n
    s, p = np.array(list(mixed)), np.array(list(mixed.values()))
    p /= p.sum()
    if not len(s) or s.max() <= 0:
        return 1.0
    if p @ s >= 0:
        return 0.1
    low, high = 1e-6, 1.0
    while p @ np.exp(high * s) < 1 and high < 50:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if p @ np.exp(mid * s) < 1 else (low, mid)
    return low


def _logistic(values: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a slightly regularised logistic curve through counts per value."""
    w = np.array([0.1, 0.0])
    x = np.stack([values, np.ones_like(values)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (toxic - (toxic + other) * p) - np.array([1.0, 1e-3]) * w
        h = (x.T * ((toxic + other) * p * (1 - p))) @ x + np.diag([1.0, 1e-3])
        step = np.linalg.solve(h, g)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def fit(rows: DataFrame) -> Model:
    """The model from all labelled rows (text, toxic 0/1); texts aren't null."""
    rows = written(rows, "labelled")  # read three times
    tokens = token_scores(written(token_tallies(rows), "tallies")).collect()
    model = Model({r["token"]: r["score"] for r in tokens}, 1.0, 1.0, -5.0)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        known: dict[str, tuple[float, ...]] = {}
        for batch in batches:
            for t, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                values, ns = np.unique(np.round(shared.value.scores(t.as_py(), known), 1), return_counts=True)
                for x, n in zip(values.tolist(), ns.tolist()):
                    counts[toxic, x] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.int32()), pa.array([k[1] for k in counts], pa.float64()), pa.array(list(counts.values()), pa.int64())],
            ["toxic", "x", "n"],
        )

    sides: tuple[dict, dict] = ({}, {})
    for r in rows.mapInArrow(histogram, "toxic int, x double, n long").groupBy("toxic", "x").agg(F.sum("n").alias("n")).collect():
        sides[r["toxic"]][r["x"]] = r["n"]
    if not sides[0] or not sides[1]:
        return Model({}, 1.0, 1.0, -5.0)  # one class only: nothing to tell apart
    model.rate = _rate(*sides)
    calibrated = rows.sparkSession.sparkContext.broadcast(model)

    def evidences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        known: dict[str, tuple[float, ...]] = {}
        for batch in batches:
            for t, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                x = calibrated.value.evidence(t.as_py(), known)[0]
                counts[toxic, round(min(x, HIGHEST) / HIGHEST * BINS)] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.int32()), pa.array([k[1] for k in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())],
            ["toxic", "x", "n"],
        )

    n = np.zeros((2, BINS + 1))
    for r in rows.mapInArrow(evidences, "toxic int, x int, n long").groupBy("toxic", "x").agg(F.sum("n").alias("n")).collect():
        n[r["toxic"], r["x"]] = r["n"]
    model.slope, model.offset = _logistic(np.arange(BINS + 1) * HIGHEST / BINS, n[1], n[0])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted, evidence, spans (word begin, end, evidence) of every row.

    A null or empty text, or one without a word, has no evidence and gets the score of none. Repeated
    rows give repeated rows, an empty table an empty one; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value, {}

        def work(ids: list, texts: list) -> pa.RecordBatch:
            found = [m.evidence(t, known) for t in texts]
            p = [m.probability(x[0]) for x in found]
            spans = [[{"word": a, "word_end": b, "evidence": e} for a, b, e in x[1]] for x in found]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(p, pa.float64()),
                    pa.array([int(x >= 0.5) for x in p], pa.int32()),
                    pa.array([x[0] for x in found], pa.float64()),
                    pa.array(spans, pa.list_(pa.struct([("word", pa.int32()), ("word_end", pa.int32()), ("evidence", pa.float64())]))),
                ],
                ["doc_id", "score", "predicted", "evidence", "spans"],
            )

        return by_bytes(batches, work)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        run,
        "doc_id long, score double, predicted int, evidence double, spans array<struct<word: int, word_end: int, evidence: double>>",
    )


def labelled(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> DataFrame:
    """text, toxic of documents with a label of 0 or 1, each text once.

    Beyond ``most`` labels a sample of about that many is taken, by a hash of the id, so that the labels
    can always be broadcast and the texts stay where they are.

    An id or text labelled twice counts as toxic if any label says so.
    """
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = marks.count()
    if total > most:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(1_000_000 * most // total))
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.join(F.broadcast(marks), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))

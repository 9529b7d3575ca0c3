"""Where the crawl of each run stops, kept up to date while its pages arrive in any order.

Three queries, each over what the one before wrote. The first parses new pages and shrinks each batch to one
place per URL. The second keeps the first place of every URL in the state store, a slice of a run's URLs to
a row, as a call per URL would cost more than its work; a URL found on an earlier
page than before is one new record less on the old page and one more on the new. The third keeps the pages
of every run and their new records, and tells the page the run stops at whenever that changes. After any
batch the answer is that of the batch rule over all pages so far.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagecat import rules
from pagecat.operators.listing import listing_entries, listing_records
from pagecat.streaming.ingest import page_stream, write_batch

PLACES = "run string, dataset_url string, page_num int, pos int"
COUNTS = "run string, page_num int, usable boolean, new_records long"
STOPS = "run string, stop int"
# Slices of a run's URLs: with 50 rows to a page, one is about as long as the run's own row of pages.
SLICES = 64


def first_places(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """First places of a slice's URLs: what their changes add to the new records of pages."""
    new = pd.concat(list(frames))
    urls, pages, positions = state.get if state.exists else ([], [], [])
    first = dict(zip(urls, zip(pages, positions)))
    changes = Counter()
    for url, page, pos in zip(new["dataset_url"].tolist(), new["page_num"].tolist(), new["pos"].tolist()):
        before = first.get(url)
        if before is not None and before <= (page, pos):
            continue
        first[url] = page, pos
        changes[page] += 1
        if before is not None:
            changes[before[0]] -= 1
    if not changes:
        return
    state.update((list(first), [page for page, _ in first.values()], [pos for _, pos in first.values()]))
    told = {page: n for page, n in changes.items() if n}
    if told:
        yield pd.DataFrame({"run": [key[0]] * len(told), "page_num": [*told], "new_records": [*told.values()]})


def stop_of(pages: np.ndarray, counts: np.ndarray, usable: np.ndarray, votes: int) -> int | None:
    """The first page that can't be used, or the last of ``votes`` pages in a row without new records."""
    order = np.argsort(pages)
    pages, counts, usable = pages[order], counts[order], usable[order]
    found = pages[~usable][:1].tolist()
    last = pages[votes - 1 :]
    empty = counts == 0
    in_row = last - pages[: len(last)] == votes - 1
    for k in range(votes):
        in_row &= empty[k : k + len(last)]
    return min([*found, *last[in_row][:1].tolist()], default=None)


def run_state(votes: int) -> Callable:
    def changed(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """A run's pages and their new records; its stop, if it is another than before.

        New records add up; ``usable`` is null (NaN) until the page's own row came, and then holds if it
        holds for all copies.
        """
        new = pd.concat(list(frames))
        pages, counts, usable, stop = state.get if state.exists else ([], [], [], None)
        every, place = np.unique(np.concatenate([np.array(pages, np.int64), new["page_num"].to_numpy(np.int64)]), return_inverse=True)
        records = np.zeros(len(every), np.int64)
        np.add.at(records, place, np.concatenate([np.array(counts, np.int64), new["new_records"].to_numpy(np.int64)]))
        good = np.full(len(every), np.nan)
        np.fmin.at(good, place, np.concatenate([np.array(usable, float), new["usable"].to_numpy(float, na_value=np.nan)]))
        told = stop_of(every, records, good != 0, votes)
        state.update((every.tolist(), records.tolist(), good.tolist(), told))
        if told != stop:
            yield pd.DataFrame({"run": [key[0]], "stop": pd.array([told], "Int32")})

    return changed


def stream_stops(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    include: str = rules.DATASET_LINK,
    exclude: str = rules.LISTING_LINK,
    files_per_batch: int = 1000,
) -> None:
    """Read all page files there are, bring the stops under ``out_dir`` up to date, and return.

    Each query starts when the one before has committed all its batches, so a batch that failed and is
    written anew was never read. State and offsets lie under ``out_dir`` too.
    """
    shown, places, counts, stops = (f"{out_dir}/{name}" for name in ("shown", "places", "counts", "stops"))

    def run(stream: DataFrame, name: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> None:
        (
            stream.writeStream.outputMode(mode)
            .foreachBatch(write)
            .option("checkpointLocation", f"{out_dir}/checkpoints/{name}")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    def parse(pages: DataFrame, batch_id: int) -> None:
        parsed = listing_entries(pages, include).persist()
        try:
            page = parsed.groupBy("run", "page_num").agg(F.bool_and(F.col("layout").isNotNull()).alias("usable"))
            write_batch(page.withColumn("new_records", F.lit(0).cast("long")), shown, batch_id)
            records = listing_records(parsed, include, exclude)
            first = records.groupBy("run", "dataset_url").agg(F.min(F.struct("page_num", "pos")).alias("place"))
            write_batch(first.select("run", "dataset_url", "place.*"), places, batch_id)
        finally:
            parsed.unpersist()

    run(page_stream(spark, in_dir, files_per_batch), "pages", parse)

    changes = (
        spark.readStream.schema(PLACES + ", batch long").option("maxFilesPerTrigger", files_per_batch).parquet(places)
        .withColumn("slice", F.pmod(F.xxhash64("dataset_url"), F.lit(SLICES)))
        .groupBy("run", "slice")
        .applyInPandasWithState(
            first_places,
            "run string, page_num int, new_records long",
            "urls array<string>, pages array<int>, positions array<int>",
            "append",
            GroupStateTimeout.NoTimeout,
        )
    )

    def count(found: DataFrame, batch_id: int) -> None:
        summed = found.groupBy("run", "page_num").agg(F.sum("new_records").alias("new_records"))
        write_batch(summed.select("run", "page_num", F.lit(None).cast("boolean").alias("usable"), "new_records"), counts, batch_id)

    run(changes, "places", count)

    def narrow(path: str) -> DataFrame:
        return spark.readStream.schema(COUNTS + ", batch long").option("maxFilesPerTrigger", files_per_batch).parquet(path).drop("batch")

    per_run = (
        narrow(shown).unionByName(narrow(counts))
        .groupBy("run")
        .applyInPandasWithState(
            run_state(rules.EMPTY_PAGES_TO_STOP),
            STOPS,
            "pages array<int>, counts array<long>, usable array<double>, stop int",
            "append",
            GroupStateTimeout.NoTimeout,
        )
    )
    run(per_run, "runs", lambda changed, batch_id: write_batch(changed, stops, batch_id))


def stops(spark: SparkSession, out_dir: str) -> DataFrame:
    """run, stop as last told; runs that don't stop are left out."""
    told = spark.read.schema(STOPS + ", batch long").parquet(f"{out_dir}/stops")
    last = told.groupBy("run").agg(F.max(F.struct("batch", "stop")).alias("last"))
    return last.select("run", "last.stop").where("stop IS NOT NULL")

"""A stream of page files gives the URLs, and the stops, that a batch gives."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagecat.operators import listing
from pagecat.plans import fixtures
from pagecat.streaming import ingest, stops

SF_DIR = "/root/testdata/sf0.01"


def keys(df):
    return sorted((r.run, r.dataset_url) for r in df.select("run", "dataset_url").collect())


@pytest.fixture
def two_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stream_equals_batch_and_resumes(spark, tmp_path, two_partitions):
    pages = fixtures.listing_pages(spark, SF_DIR).cache()
    arriving, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"

    def arrive(part):
        part.repartition("page_num").write.mode("append").parquet(arriving)
        ingest.stream_pages(spark, arriving, out, state, files_per_batch=3).awaitTermination()

    arrive(pages.where("page_num < 25"))
    some = keys(spark.read.parquet(out))
    arrive(pages.where("page_num >= 15"))  # pages 15 to 24 come again
    batch = listing.dedup_first_seen(listing.listing_records(listing.listing_entries(pages)))
    streamed = keys(spark.read.parquet(out))
    assert streamed == keys(batch)
    # Pages came in order, so the first copy of every URL is the batch job's, in all columns.
    columns = sorted(set(batch.columns))
    rows = lambda df: sorted(map(tuple, df.select(columns).collect()))
    assert rows(spark.read.parquet(out)) == rows(batch)
    assert len(set(streamed)) == len(streamed) > len(some)
    ingest.stream_pages(spark, arriving, out, state).awaitTermination()
    assert keys(spark.read.parquet(out)) == streamed


def page(items, layout=True):
    links = "".join(f'<tr><td><a href="/datasets/{i}">n{i}</a></td><td>x</td></tr>' for i in items)
    return f"<table><tbody>{links}</tbody></table>" if layout else "<p>down</p>"


def pages_of(spark, *runs):
    rows = [(f"r{k}", p, "https://x.example/datasets", html) for k, run in enumerate(runs) for p, html in enumerate(run) if html]
    return spark.createDataFrame(rows, "run string, page_num int, url string, html string")


def test_stream_survives_a_failed_batch(spark, tmp_path, two_partitions, monkeypatch):
    pages = pages_of(spark, [page([p, p + 1, 7]) for p in range(6)])
    arriving, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    for p in range(6):  # files in page order, as a file's time decides when it is read
        pages.where(F.col("page_num") == p).coalesce(1).write.mode("append").parquet(arriving)
    plain, failed = ingest.write_batch, []

    def fails(df, out_dir, batch_id):
        plain(df, out_dir, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "write_batch", fails)
    with pytest.raises(Exception, match="lost"):
        ingest.stream_pages(spark, arriving, out, state, files_per_batch=2).awaitTermination()
    ingest.stream_pages(spark, arriving, out, state, files_per_batch=2).awaitTermination()
    batch = listing.dedup_first_seen(listing.listing_records(listing.listing_entries(pages)))
    columns = sorted(batch.columns)
    rows = lambda df: sorted(map(tuple, df.select(columns).collect()))
    assert failed == [1] and rows(spark.read.parquet(out)) == rows(batch)


def test_state_alone_knows_what_was_written(spark, tmp_path, two_partitions):
    pages = pages_of(spark, [page([1, 2]), page([2, 3])])
    arriving, state = f"{tmp_path}/in", f"{tmp_path}/state"
    for p in range(2):
        pages.where(F.col("page_num") == p).coalesce(1).write.mode("append").parquet(arriving)
        ingest.stream_pages(spark, arriving, f"{tmp_path}/out{p}", state).awaitTermination()
    found = [[u.rsplit("/", 1)[1] for _, u in keys(spark.read.parquet(f"{tmp_path}/out{p}"))] for p in range(2)]
    assert found == [["1", "2"], ["3"]]  # nothing of the first folder could be read in the second run


RUNS = (
    [page([p]) for p in range(4)] + [page([1]), page([2, 3]), page([0]), page([9]), page([10])],  # three empty pages: stops at 6
    [page([0, 1]), page([1]), page([0], layout=False), page([5])],  # unusable at 2
    [page([0]), page([0]), None, page([0]), page([0]), page([8])],  # a gap breaks the row
    [page([5]), page([5]), page([5]), page([5])],  # stops at 3
)


@pytest.mark.parametrize("seed", [1, 2])
def test_stops_in_any_order_are_the_batch_rules(spark, tmp_path, two_partitions, seed):
    pages = pages_of(spark, *RUNS).cache()
    arriving, out = f"{tmp_path}/in", f"{tmp_path}/out"
    names = [(r.run, r.page_num) for r in pages.collect()]
    random.Random(seed).shuffle(names)
    so_far = []
    for wave in (names[:10], names[10:] + names[:2]):  # some pages come again
        so_far += wave
        mine = lambda some: F.struct("run", "page_num").isin([F.struct(F.lit(r), F.lit(p)) for r, p in some])
        pages.where(mine(wave)).coalesce(1).write.mode("append").parquet(arriving)
        stops.stream_stops(spark, arriving, out)
        entries = listing.listing_entries(pages.where(mine(so_far)))
        first = listing.dedup_first_seen(listing.listing_records(entries))
        expected = {(r.run, r.stop) for r in listing.stop_pages(first, entries).collect()}
        assert {(r.run, r.stop) for r in stops.stops(spark, out).collect()} == expected
    assert expected == {("r0", 6), ("r1", 2), ("r3", 3)}


def test_stop_of_pages():
    stop = lambda pages, counts, usable=None: stops.stop_of(
        np.array(pages, int), np.array(counts, int), np.array(usable or [True] * len(pages), bool), 3
    )
    assert stop([], []) is None and stop([0, 1], [0, 0]) is None
    assert stop([2, 0, 1], [0, 0, 0]) == 2 and stop([0, 1, 3], [0, 0, 0]) is None
    assert stop([0, 1, 2, 3], [1, 1, 1, 1], [True, True, False, True]) == 2
    assert stop([0, 1, 2, 3], [0, 0, 0, 1], [True, True, True, False]) == 2


class _State:
    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def test_one_call_keeps_the_first_places_of_many_urls():
    state, columns = _State(), ["dataset_url", "page_num", "pos"]
    tell = lambda *rows: [
        (r.page_num, r.new_records)
        for f in stops.first_places(("r", 5), iter([pd.DataFrame(rows, columns=columns)]), state)
        for r in f.itertuples()
    ]
    assert sorted(tell(("a", 3, 0), ("b", 3, 1), ("c", 4, 0))) == [(3, 2), (4, 1)]
    assert tell(("a", 3, 2), ("b", 7, 0)) == []
    assert sorted(tell(("a", 1, 0), ("c", 4, 0), ("b", 2, 9), ("b", 2, 1))) == [(1, 1), (2, 1), (3, -2)]
    assert state.get == (["a", "b", "c"], [1, 2, 4], [0, 1, 0])

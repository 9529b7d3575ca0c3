"""New page files to records as they arrive, every URL once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagecat import rules
from pagecat.operators.listing import listing_entries, listing_records
from pagecat.schemas import PAGES


def page_stream(spark: SparkSession, in_dir: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(in_dir)
    )


def write_batch(df: DataFrame, out_dir: str, batch_id: int) -> None:
    """Write the rows of a batch as a partition of its own; a batch that runs again replaces it."""
    (
        df.withColumn("batch", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(out_dir)
    )


def first_arrivals(records: DataFrame) -> DataFrame:
    """Streamed records by run and URL: the first copy, and since and until when copies arrived.

    A batch has one time, which Spark logs with it, so a restarted batch sees the same. Copies that came
    with the first batch win over later ones, among them the first by page and position. The state is an
    aggregate per URL in the state store, committed with the batch; a URL on every page shrinks in the
    tasks first.
    """
    keys = ["run", "dataset_url"]
    kept = [c for c in records.columns if c not in keys]
    seen = records.withColumn("arrived", F.current_timestamp())
    first = F.min_by(F.struct(*kept), F.struct("arrived", "page_num", "pos"))
    return seen.groupBy(*keys).agg(
        first.alias("r"), F.min("arrived").alias("since"), F.max("arrived").alias("until")
    )


def stream_pages(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    include: str = rules.DATASET_LINK,
    exclude: str = rules.LISTING_LINK,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Read all page files there are and stop; run again for new ones.

    Within a batch the first copy of a URL by page and position wins, as in a batch job. A URL of an earlier
    batch is known from the state store: its copies span two batches' times, so it isn't written again.
    Nothing that was written is ever read back.
    """
    pages = page_stream(spark, in_dir, files_per_batch)
    arrivals = first_arrivals(listing_records(listing_entries(pages, include), include, exclude))

    def write(changed: DataFrame, batch_id: int) -> None:
        new = changed.where(F.col("since") == F.col("until"))
        write_batch(new.select("run", "dataset_url", "r.*"), out_dir, batch_id)

    return (
        arrivals.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

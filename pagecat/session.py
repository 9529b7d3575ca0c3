"""Session settings the operators rely on, and the shared folder for files between stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Time zone: dates and timestamps are compared as text in UTC.
# Skew join: a join whose two sides are plain shuffles splits a hot partition at run time.
# Sort aggregates: rows that come sorted by their key are grouped in one pass, without a hash table.
# RocksDB: the URLs already seen by a stream outgrow executor heap; of each batch only the changes are saved.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings only a new session takes. Operators build large expressions, and recording a call site
# for each part costs seconds per query.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session; partition counts stay the cluster's."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for files written between stages.

    It lies in the shared folder that ``spark.checkpoint.dir`` names. Only a local master may leave
    that unset: its files go to a folder beside the warehouse then.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-stages"
    return f"{shared.rstrip('/')}/pagecat-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table that later steps read more than once, and read it back.

    The plan behind it then runs once, and a lost executor costs no more than the table's own files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "lz4_raw").parquet(path)  # read soon and seldom: speed before size
    return df.sparkSession.read.schema(df.schema).parquet(path)

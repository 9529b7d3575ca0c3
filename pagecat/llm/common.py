"""Helpers the operators share: inputs, folds, shared scratch tables, Arrow batches by bytes."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text one Python step holds at a time.
BATCH_BYTES = 8 << 20


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, if they have no other copy."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so that extra columns can't clash with its own."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of the table has, whichever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"llm_{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a session on a local master may leave the setting unset; its checkpoints then go to a
    folder of the working directory.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        shared = os.path.abspath("spark-checkpoints")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made, once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def by_bytes(
    batches: Iterator[pa.RecordBatch], work: Callable[[list, list], pa.RecordBatch], most: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Regroup rows of (id, text) so that each call sees about ``most`` characters of text.

    One text is never split here, so a call holds one text more than ``most`` at worst.
    """
    ids: list = []
    texts: list = []
    held = 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            t = t.as_py()
            ids.append(i)
            texts.append(t)
            held += len(t) if t else 0
            if held >= most or len(ids) >= 20_000:
                yield work(ids, texts)
                ids, texts, held = [], [], 0
    if ids:
        yield work(ids, texts)

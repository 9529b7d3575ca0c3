"""Bookkeeping of runs: stage times, outcomes, durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecat import rules
from pagecat.functions.numbers import ratio_text_expr


def stage_timestamps(events: DataFrame) -> DataFrame:
    """Latest completion of each of the four stages of every run, '' if never.

    Exit codes 0 and 1 count as completed. One aggregate by run; the stages are columns until the
    last step, so no join is needed to list those that never ran.
    """
    done = F.col("exit_code").isin(0, 1)
    name = F.replace("name", F.lit("_"), F.lit("-"))
    latest = events.groupBy("run").agg(
        *(F.max(F.when(done & (name == stage), F.col("end_time"))).alias(stage) for stage in rules.STAGES)
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(stage).alias("task"),
                F.coalesce(F.date_format(f"`{stage}`", "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias("time"),
            )
            for stage in rules.STAGES
        )
    )
    return latest.select("run", F.inline(entries))


def run_outcome(stages: DataFrame) -> DataFrame:
    """success where every stage of a run succeeded or was skipped by its user, else failed."""
    good = F.coalesce(F.col("status").isin("success", "user_skipped"), F.lit(False))
    return stages.groupBy("run").agg(
        F.count(F.lit(1)).alias("stages"),
        F.when(F.bool_and(good), "success").otherwise("failed").alias("overall_status"),
    )


def stage_durations(events: DataFrame) -> DataFrame:
    """Wall time of every stage run as text, two digits."""
    def micros(name: str) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp"))

    seconds = ratio_text_expr(micros("end_time") - micros("start_time"), 1_000_000)
    text = F.concat(seconds, F.lit("s"))
    return events.withColumn("duration", text)

"""How full the fields are, which values they hold, and what a catalogue holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagecat.functions.numbers import round_one_digit_expr
from pagecat.functions.values import filled_expr
from pagecat.schemas import BASE_FIELDS
from pagecat.session import stage


def _rate(filled, total):
    percent = filled.cast("double") / total.cast("double") * 100
    return F.when(total == 0, F.lit(0.0)).otherwise(round_one_digit_expr(percent))


def field_completion(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Per field: filled, total, rate. One aggregate over all fields, then turned."""
    names = fields or df.columns
    types = {f.name: f.dataType for f in df.schema}
    wide = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *(F.count_if(filled_expr(F.col(name), types[name])).alias(name) for name in names),
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("field"),
                F.col(name).alias("filled"),
                F.col("_total").alias("total"),
            )
            for name in sorted(names)
        )
    )
    rows = wide.select(F.inline(entries))
    return rows.withColumn("completion_rate", _rate(F.col("filled"), F.col("total")))


def _as_text(name: str, dtype: T.DataType):
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(name)
    return F.col(name).cast("string")


def field_statistics(df: DataFrame, field: str | None = None) -> DataFrame:
    """Per field and value: how often it occurs, beside the field's own totals.

    One row per distinct value (fields never filled have one row without a value), as values may be
    as many as records. Lists and structs count by their JSON text. The counts are written once and
    read twice.
    """
    if field is not None and field not in df.columns:
        raise KeyError(f"field {field!r} not found; available: {', '.join(df.columns)}")
    names = [field] if field else df.columns
    types = {f.name: f.dataType for f in df.schema}
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("field"),
                F.when(filled_expr(F.col(name), types[name]), _as_text(name, types[name])).alias("value"),
            )
            for name in names
        )
    )
    counts = stage(
        df.select(F.inline(entries)).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")),
        "value-counts",
    )
    per_field = counts.groupBy("field").agg(
        F.sum("n").cast("bigint").alias("total"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0))
        .cast("bigint")
        .alias("filled"),
        F.count("value").alias("unique_values_count"),
    )
    # One row per column of the input on the right: small by construction.
    joined = counts.join(F.broadcast(per_field), "field").where(
        F.col("value").isNotNull() | (F.col("filled") == 0)
    )
    return joined.select(
        "field",
        "total",
        "filled",
        _rate(F.col("filled"), F.col("total")).alias("completion_rate"),
        "unique_values_count",
        "value",
        F.when(F.col("value").isNotNull(), F.col("n")).alias("value_count"),
    )


def catalog_summary(
    df: DataFrame, fields: tuple[str, ...] = ("species", "product", "sample_type")
) -> DataFrame:
    """Distinct values of the main fields and the number of records, one row per value.

    A missing key counts as Unknown, an empty text stays empty.
    """
    entries = F.array(
        *(
            F.struct(F.lit(f).alias("field"), F.coalesce(f, F.lit("Unknown")).alias("value"))
            for f in fields
        )
    )
    values = stage(
        df.select(F.inline(entries)).groupBy("field", "value").agg(F.count(F.lit(1)).alias("records")),
        "catalog-values",
    )
    total = values.where(F.col("field") == fields[0]).agg(
        F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("total_datasets")
    )
    return values.crossJoin(total)  # one row on the right


def field_catalog(df: DataFrame) -> DataFrame:
    """Fields of a catalogue in order, whether each was there from the start or added, and the
    number of records that have them."""
    entries = F.array(
        *(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("field"),
                F.lit("original" if name in BASE_FIELDS else "enriched").alias("origin"),
            )
            for i, name in enumerate(df.columns)
        )
    )
    total = df.agg(F.count(F.lit(1)).alias("total_datasets"))
    return total.select("total_datasets", F.inline(entries))

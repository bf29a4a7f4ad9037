"""Joins that add reference data to the log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.operators.sizing import broadcast_if_small, require_columns

OPS_KEYS = ("aeropuerto_oaci", "mes_id", "internacional_domestico")


def left_enrich(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Left join of chosen columns, where two missing key values count as equal."""
    require_columns(left, keys)
    require_columns(right, [*keys, *values])
    side = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *values)
    same: Column = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    return left.join(broadcast_if_small(side), on=same, how="left").select(*left.columns, *values)


def join_monthly_operations(flights: DataFrame, monthly: DataFrame) -> DataFrame:
    """Monthly operation count of the flight's airport, month and I/D code."""
    return left_enrich(flights, monthly, OPS_KEYS, ["cnt_operaciones"])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row: must be empty before ``df`` is the right side of an enrichment."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def as_of_join(
    left: DataFrame,
    readings: DataFrame,
    by: str,
    left_ts: str,
    reading_ts: str,
    values: Sequence[str],
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Latest reading at or before each left row, per station; no reading gives nulls.

    Time is cut into buckets. A left row looks among the readings of its own bucket, and else takes the
    last one of the buckets before; that is found on a table of one row per station and bucket that
    holds left rows or readings. So the join is an equality that makes no row twice, and left rows are
    neither sorted nor gathered by station. Of several readings at one instant the largest is taken
    whole, by its values in their order.
    """
    reading = F.struct(F.col("_from"), F.col("_values"))
    known = (
        readings.filter(F.col(by).isNotNull() & F.col(reading_ts).isNotNull())
        .groupBy(F.col(by).alias("_by"), F.col(reading_ts).alias("_from"))
        .agg(F.max(F.struct(*values)).alias("_values"))
        .groupBy("_by", _bucket("_from", bucket_seconds).alias("_bucket"))
        .agg(F.collect_list(reading).alias("_inside"), F.max(reading).alias("_last"))
    )
    asked = left.select(F.col(by).alias("_by"), _bucket(left_ts, bucket_seconds).alias("_bucket")).na.drop().distinct()
    before = W.partitionBy("_by").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    side = (
        known.join(asked.withColumn("_asked", F.lit(True)), on=["_by", "_bucket"], how="full")
        .withColumn("_before", F.last("_last", ignorenulls=True).over(before))
        .filter("_asked").select("_by", "_bucket", "_inside", "_before")
    )
    match = (F.col(by) == F.col("_by")) & (_bucket(left_ts, bucket_seconds) == F.col("_bucket"))
    latest = F.array_max(F.filter("_inside", lambda r: r["_from"] <= F.col(left_ts)))
    found = left.join(broadcast_if_small(side), on=match, how="left").withColumn("_found", F.coalesce(latest, "_before"))
    return found.select(
        *left.columns, F.col("_found._from").alias("lectura_ts"), *[F.col(f"_found._values.{v}").alias(v) for v in values]
    )


def _bucket(ts: Column | str, seconds: int) -> Column:
    """Whole buckets since the epoch, read from the wall clock."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_timestamp(ts) / seconds)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def stack_tagged(frames: dict[str, DataFrame], tag: str = "variable") -> DataFrame:
    """Bag union of one table per name, with the name in a column of its own."""
    return stack([df.select(F.lit(name).alias(tag), *df.columns) for name, df in frames.items()])

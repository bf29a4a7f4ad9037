"""Row selection: scope cut, support filters, top-n membership, exact-size samples."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.operators.ranking import rank_limits, stable_order
from slotwise.operators.sizing import broadcast_if_small, drop_null_keys, require_columns


def scope_cut(
    flights: DataFrame,
    airport: str = "SCTE",
    date_from: str = "2020-01-01",
    date_to: str = "2026-01-01",
    activities: Sequence[str] = ("U",),
    zone: str | None = None,
) -> DataFrame:
    """One airport, one half-open period in local time, some activities. All three reach the scan.

    The limits are midnights of ``zone`` (else of the session zone) for zoned times. A log stored by year (column
    ``anio_operacion``) is read only in the years that the period touches in any zone.
    """
    require_columns(flights, ["aeropuerto_oaci", "dt_operacion", "actividad_cod"])
    kind = flights.schema["dt_operacion"].dataType
    first, end = (_midnight(d, kind, zone) for d in (date_from, date_to))
    if "anio_operacion" in flights.columns:
        years = [(date.fromisoformat(d) + timedelta(days=n)).year for d, n in ((date_from, -1), (date_to, 1))]
        flights = flights.filter(F.col("anio_operacion").between(*years))
    return flights.filter(
        (F.col("aeropuerto_oaci") == airport)
        & (F.col("dt_operacion") >= first)
        & (F.col("dt_operacion") < end)
        & F.col("actividad_cod").isin(*activities)
    )


def _midnight(day: str, kind: T.DataType, zone: str | None) -> Column:
    if zone and isinstance(kind, T.TimestampType):
        return F.lit(datetime.fromisoformat(day).replace(tzinfo=ZoneInfo(zone)))
    return F.lit(day).cast(kind)


def with_group_size(df: DataFrame, keys: Sequence[str], name: str = "n_obs_grupo") -> DataFrame:
    """Size of each row's group, next to the row; rows with a missing key get null.

    Sizes are counted first (with map-side merging) and joined back, so that a group holding much of
    the table is never gathered in one task.
    """
    sizes = drop_null_keys(df, keys).groupBy(*keys).agg(F.count("*").alias(name))
    return df.join(broadcast_if_small(sizes), on=list(keys), how="left")


def with_support(df: DataFrame, keys: Sequence[str], at_least: int = 3) -> DataFrame:
    """Rows whose group has at least ``at_least`` rows."""
    return with_group_size(df, keys).filter(F.col("n_obs_grupo") >= at_least)


def top_values(df: DataFrame, column: str, n: int, count: str = "n") -> DataFrame:
    """The ``n`` most frequent values; missing values are not counted; ties go to the smaller value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias(count))
        .orderBy(F.col(count).desc(), F.col(column))
        .limit(n)
    )


def among_top(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose value is one of the ``n`` most frequent; the ``n`` rows are safe to broadcast."""
    best = top_values(df, column, n).select(column)
    return df.join(F.broadcast(best), on=column, how="left_semi")


def head_by(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of an order that the caller makes total by a key."""
    return df.orderBy(*order).limit(n)


def sample_exactly(df: DataFrame, key: str | Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, the same on every run: those with the smallest hashes of ``key``.

    The limiting hash is found from a sketch and a count (two scans, no sort of the table); rows are then
    only filtered by it. Of rows that share the key at the limit, the smallest by all columns are taken.
    """
    keys = [key] if isinstance(key, str) else list(key)
    hashed = df.withColumn("_h", F.coalesce(stable_order(*keys, seed=seed), F.lit(0).cast("long")))
    total = df.count()
    if total <= n:
        return df
    edge = rank_limits(hashed, "_h", [n / total], ranks=[n]).first()
    below = hashed.filter(F.col("_h") <= edge["_limit0"])
    left = n - edge["_upto0"]
    if not left:
        return below.drop("_h")
    at_edge = hashed.filter(F.col("_h") == hashed.filter(F.col("_h") > edge["_limit0"]).agg(F.min("_h")).first()[0])
    return below.unionByName(at_edge.orderBy(*df.columns).limit(left)).drop("_h")


def stratified_parts(
    df: DataFrame,
    key: str,
    stratum: str,
    fractions: Sequence[float],
    seed: int = 42,
    name: str = "part",
) -> DataFrame:
    """Number the rows 0, 1, .. so that each part holds its fraction of every stratum.

    The limits are exact ranks of a hash of the unique ``key`` within the stratum, found without a sort
    of the rows; rows are only compared with the limits of their stratum. Rows whose stratum is missing
    are a stratum of their own.
    """
    hashed = df.withColumn("_h", stable_order(key, seed=seed))
    shares, total = [], 0.0
    for fraction in fractions[:-1]:
        total += fraction
        shares.append(total)
    if not shares:
        return df.withColumn(name, F.lit(0))
    edges = rank_limits(hashed, "_h", shares, [stratum]).withColumnRenamed(stratum, "_stratum")
    part = F.lit(0)
    for i in range(len(shares)):
        part = part + F.when(F.col("_h") <= F.col(f"_limit{i}"), 0).otherwise(1)
    side = broadcast_if_small(edges.drop(*[f"_upto{i}" for i in range(len(shares))]))
    return (
        hashed.join(side, on=F.col(stratum).eqNullSafe(F.col("_stratum")), how="left")
        .withColumn(name, part)
        .select(*df.columns, name)
    )

"""Cleaning of the event log: repairs, imputation, derived keys, category codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions import cleaning as C
from slotwise.functions import clock
from slotwise.operators.ranking import column_quantiles, exact_quantiles, with_rank
from slotwise.operators.sizing import broadcast_if_small, require_columns

def impute_group_median(
    df: DataFrame, column: str, group: str, flag: str | None = None
) -> DataFrame:
    """Fill missing numbers with the exact median of the row's group, else with the global median.

    The flag marks the filled rows. Medians are learnt from the recorded values only; one row per
    group comes back to the rows through a size-checked join.
    """
    require_columns(df, [column, group])
    flag = flag or f"{column}_fue_imputado"
    by_group = exact_quantiles(df, column, [0.5], ["_group_median"], keys=[group])
    overall = exact_quantiles(df, column, [0.5], ["m"]).first()
    fallback = F.lit(overall["m"] if overall else None).cast("double")
    return (
        df.withColumn(flag, C.flag(F.col(column).isNull()))
        .join(broadcast_if_small(by_group), on=group, how="left")
        .withColumn(column, F.coalesce(F.col(column), F.col("_group_median"), fallback))
        .drop("_group_median")
        .select(*df.columns, flag)
    )


def preprocess_log(flights: DataFrame) -> DataFrame:
    """Sentinel flight number, repaired and imputed weight, month key, international/domestic code."""
    require_columns(
        flights, ["numero_vuelo", "pmd", "modelo_avion", "dt_operacion", "es_internacional"]
    )
    repaired = flights.withColumns({
        "numero_vuelo": C.fill_text("numero_vuelo"),
        "pmd": C.zero_to_null(C.to_number("pmd")),
    })
    return impute_group_median(repaired, "pmd", "modelo_avion").withColumns({
        "mes_id": clock.month_key("dt_operacion"),
        "internacional_domestico": C.border_code("es_internacional"),
    })


def localise(df: DataFrame, zone: str, ts: str = "dt_operacion") -> DataFrame:
    """Zoned times as wall-clock times of ``zone``, whatever the session zone; others stay as they are."""
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return df.withColumn(ts, clock.in_zone(ts, zone))
    return df


def with_calendar(df: DataFrame, ts: str = "dt_operacion") -> DataFrame:
    """Minute of day, year, month, weekday from Monday = 0, and 'yyyy-MM'."""
    return df.withColumns({
        "min_dia": clock.minute_of_day(ts),
        "anio": F.year(ts),
        "mes": F.month(ts),
        "dia_semana": clock.weekday_from_monday(ts),
        "mes_ym": clock.month_text(ts),
    })


def impute_medians(
    df: DataFrame, columns: Sequence[str], learn_on: DataFrame | None = None
) -> DataFrame:
    """Fill each column with its exact median in ``learn_on`` (the training rows)."""
    source = learn_on if learn_on is not None else df
    found = column_quantiles(source, columns, [0.5], ["m"]).collect()  # a row per column
    fills = {r["variable"]: r["m"] for r in found}
    return df.withColumns({c: F.col(c).cast("double") for c in columns}).na.fill(fills)


def category_table(df: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct non-null values with their 0-based alphabetical position.

    Values are dealt by range and numbered inside their cell; the cells before it give the offset.
    """
    values = df.select(column).na.drop().distinct()
    return with_rank(values, column, name=code).withColumn(code, F.col(code) - 1)


def category_code(df: DataFrame, column: str, name: str) -> DataFrame:
    """Alphabetical code from 0; a missing value gets -1."""
    codes = broadcast_if_small(category_table(df, column, name))
    out = df.join(codes, on=column, how="left")
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(-1).cast("long"))).select(*df.columns, name)


def label_code(df: DataFrame, column: str, name: str, missing: str = "nan") -> DataFrame:
    """Alphabetical code from 0 of the value as text; a missing value is a category of its own."""
    as_text = F.coalesce(F.col(column).cast("string"), F.lit(missing))
    held = df.withColumn("_label", as_text)
    codes = broadcast_if_small(category_table(held, "_label", name))
    return held.join(codes, on="_label").select(*df.columns, name)


def drop_empty_columns(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Drop those candidate columns that hold no value at all."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        return df
    filled = df.agg(*[F.count(c).alias(c) for c in present]).first()
    return df.drop(*[c for c in present if filled[c] == 0])

"""Repairs, coercions, flags and encodings of single columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text written for a missing flight number.
UNKNOWN_FLIGHT = "DESCONOCIDO"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: every NaN of a float column becomes null."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


def fill_text(c: Column | str, text: str = UNKNOWN_FLIGHT) -> Column:
    return F.coalesce(_col(c), F.lit(text))


def to_number(c: Column | str) -> Column:
    """A double, or null where the value is not a number."""
    number = _col(c).try_cast("double")
    return F.nanvl(number, F.lit(None).cast("double"))


def zero_to_null(c: Column | str) -> Column:
    """A zero that stands for 'not recorded' becomes null."""
    return F.nullif(_col(c), F.lit(0.0))


def border_code(c: Column | str) -> Column:
    """International / domestic code of a boolean: true 'I', false 'D', null stays null."""
    return F.when(_col(c), F.lit("I")).when(~_col(c), F.lit("D"))


def flag(condition: Column) -> Column:
    """1/0 of a condition, where an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def exceeds(c: Column | str, threshold: float) -> Column:
    return flag(_col(c) > F.lit(threshold))


def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Bounded value; null stays null (``least``/``greatest`` alone would replace it)."""
    value = _col(c)
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(value.isNotNull(), out)


def share(c: Column) -> Column:
    """Mean of a condition over all rows, an unknown condition counting as false."""
    return F.avg(flag(c).cast("double"))


def pseudonym(c: Column | str, salt: str) -> Column:
    """A salted SHA-256 of an identifier; null stays null."""
    return F.when(_col(c).isNotNull(), F.sha2(F.concat(F.lit(salt), _col(c).cast("string")), 256))

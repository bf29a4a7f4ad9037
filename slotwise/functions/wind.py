"""Weather expressions for one runway."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _angle(direction: Column | str, heading: float) -> Column:
    direction = F.col(direction) if isinstance(direction, str) else direction
    return F.radians(direction.cast("double") - F.lit(float(heading)))


def cross_wind(speed: str, direction: str, heading: float = 170) -> Column:
    """Wind across the runway; with no direction, half of the speed."""
    across = F.col(speed) * F.abs(F.sin(_angle(direction, heading)))
    return F.coalesce(across, F.col(speed) * F.lit(0.5))


def head_wind(speed: str, direction: str, heading: float = 170) -> Column:
    """Wind along the runway; with no direction, zero."""
    return F.coalesce(F.col(speed) * F.cos(_angle(direction, heading)), F.lit(0.0))

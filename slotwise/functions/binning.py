"""Binning expressions. Bins are closed on the right, ``(a, b]``; values outside get null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band edges and labels of daily rain (mm) and of cross wind (km/h).
RAIN_EDGES = [-0.1, 0.0, 1.0, 5.0, 15.0, 1000.0]
RAIN_LABELS = ["Sin lluvia", "0-1 mm", "1-5 mm", "5-15 mm", "> 15 mm"]
WIND_EDGES = [-0.1, 5.0, 10.0, 20.0, 30.0, 100.0]
WIND_LABELS = ["< 5", "5-10", "10-20", "20-30", "> 30"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(c: Column | str, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Label (or 0-based index) of the right-closed band that holds the value."""
    value = _col(c)
    names = list(labels) if labels is not None else list(range(len(edges) - 1))
    out = F.when(value <= F.lit(edges[0]), F.lit(None))
    for upper, name in zip(edges[1:], names):
        out = out.when(value <= F.lit(upper), F.lit(name))
    return out


def quantile_band(c: Column | str, edges: Sequence[float]) -> Column:
    """0-based index among distinct quantile edges, the lowest edge included in the first bin."""
    value = _col(c)
    inner = sorted(set(edges))[1:-1]
    out = F.lit(0)
    for edge in inner:
        out = out + F.when(value > F.lit(edge), 1).otherwise(0)
    return F.when(value.isNotNull(), out)


def equal_width_bin(c: Column | str, low: Column, high: Column, bins: int) -> Column:
    """1-based equal-width bin over [low, high]; the maximum falls in the last bin."""
    value = _col(c)
    width = (high - low) / F.lit(float(bins))
    raw = F.floor((value - low) / width) + 1
    return F.when(value.isNotNull(), F.when(width == 0, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int"))

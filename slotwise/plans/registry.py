"""Named queries, each with the SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its check if there is one."""
    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return build
    return add


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded and small integers widened, so that both engines print the same values."""
    out = {}
    for f in df.schema:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # Adding zero turns a negative zero into a plain one.
            out[f.name] = F.round(F.col(f.name).cast("double"), places) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out[f.name] = F.col(f.name).cast("long")
    return df.withColumns(out) if out else df

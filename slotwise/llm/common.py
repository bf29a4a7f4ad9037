"""Small helpers of the operators: chosen columns, stored steps, Arrow batches of bounded bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slotwise.session import scratch_path


def chosen(df: DataFrame, **names: str | Column) -> DataFrame:
    """Only the named columns, under the operator's own names, so that extra columns cannot clash."""
    return df.select(*(
        (df[f"`{n}`"] if isinstance(n, str) else n).alias(alias) for alias, n in names.items()
    ))


def stored(df: DataFrame, name: str, scratch: list[str] | None = None) -> DataFrame:
    """Write a step that later steps share to the shared folder and read it back; this cuts its lineage.

    Its path is added to ``scratch``, for ``discard`` when nothing reads it any more.
    """
    path = scratch_path(df.sparkSession, name)
    if scratch is not None:
        scratch.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, scratch: list[str]) -> None:
    """Delete stored steps that no result depends on."""
    for name in scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    scratch.clear()


def small_batches(spark: SparkSession, rows: int = 1000, most: int | None = None) -> None:
    """Hand texts to Python workers in batches that stay small when texts are long: of few rows, and of few bytes."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if most:
        now = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") or ""
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def gathered(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches joined until ``column`` holds about ``most`` bytes; a longer single batch is passed on alone."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def give_back() -> None:
    """Hand freed memory back to the system: Arrow's, and the C library's where it offers that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_arrow(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` by workers that keep no freed memory: Spark holds them between tasks, several a core beside the JVM."""

    def run_and_give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(run_and_give_back, schema)


def text_key(text: Column) -> Column:
    """A 16-byte key of a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))

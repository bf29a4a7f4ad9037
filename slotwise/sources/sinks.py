"""Sinks: materialised tables, report facts, fitted models."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write Parquet (by partition columns if given) and read it back, which also ends the lineage.

    The table is written beside its place and put there when it is complete: a job that fails leaves the old
    table as it was, and a table may be replaced by one that is computed from it. Where moving a folder is
    one step, as on HDFS, readers miss the table for the moment between two such steps only.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    new, old = (f"{path}__{word}-{uuid.uuid4().hex}" for word in ("new", "old"))
    at = lambda name: spark._jvm.org.apache.hadoop.fs.Path(name)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.partitionBy(*partition_by).parquet(new)
        replaced = fs.exists(at(path))
        if replaced and not fs.rename(at(path), at(old)):
            raise OSError(f"cannot move {path}")
        if not fs.rename(at(new), at(path)):
            if replaced:
                fs.rename(at(old), at(path))
            raise OSError(f"cannot move {new}")
        if replaced:
            fs.delete(at(old), True)
    finally:
        fs.delete(at(new), True)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)


def save_bucketed(
    df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = (), append: bool = False,
) -> DataFrame:
    """Write a Parquet table dealt by ``keys`` into ``buckets``, one file each, and read it back.

    Windows, groupings and joins on the keys (or on more columns) then read it without a shuffle. ``path`` must be
    new unless rows are appended; appended rows go to further files of the same buckets.
    """
    dealt = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *sort_by)
    dealt.option("path", path).mode("append" if append else "error").saveAsTable(name)
    return df.sparkSession.table(name)


def attach_bucketed(
    spark: SparkSession, name: str, path: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = (),
) -> DataFrame:
    """A table of ``save_bucketed`` under a name in this session, whose catalog may have forgotten it."""
    listed = lambda names: ", ".join(f"`{n}`" for n in names)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({listed(keys)}) "
        f"SORTED BY ({listed([*keys, *sort_by])}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def save_facts(facts: DataFrame, path: str) -> DataFrame:
    """Report facts as one Parquet table of category, key and value."""
    return save_table(facts.select("categoria", "clave", "valor"), path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)

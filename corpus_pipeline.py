"""A training corpus from raw documents: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import bpe, decontaminate, language, minhash, substrings
from slotwise.llm.common import stored
from slotwise.llm.queries import VOCABULARY

#: A document goes if its language is unknown or its score is lower than this.
LEAST_SCORE = 0.35
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    rows = docs.withColumn("__whole", F.col("text"))
    out = language.predict(rows, language.fit(docs), {c: c for c in ("doc_id", "__whole", "lang", "source", "n_chars")})
    kept = out.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumnRenamed("__whole", "text").select(*COLUMNS)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class; rows without an id stay."""
    first = minhash.classes(docs).filter("doc_id = class_id").select("doc_id").distinct()
    rows = docs.filter("doc_id is not null").join(first, "doc_id", "left_semi")
    return rows.dropDuplicates(["doc_id"]).select(*COLUMNS).unionAll(docs.filter("doc_id is null").select(*COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones hold."""
    out = substrings.remove_repeats(docs, keep=("lang", "source"))
    text = F.col("kept")
    return out.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, items).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of ids of every document, and digests of the ids and of what they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_duplicates", one_of_each_class),
    ("substrings", without_repeats),
    ("decontamination", no_benchmark),
    ("tokens", tokens),
]
ORACLE_SQL = None  # stages learn, hash or tokenise, which SQL cannot express; tests compare with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

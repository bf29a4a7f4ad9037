"""Token counts from flat, unindexed token files.

A file is nothing but token ids of a fixed width, one document after the other, each followed by the end-of-document
id. ``write_tokens`` writes such files with Spark's text writer, whose line separator is that id's bytes. ``scan`` cuts
each file into blocks, finds the separators of a block with one vectorised comparison, and reports the pieces between
them. What a block begins or ends with may be part of a document only: a prefix scan over the separators of the blocks
numbers the documents, and pieces of one number are added up.

A document can begin with a key, its id as five tokens of 15 bits, so that counts can be told apart without an index.
Null and empty texts are documents without tokens. Null ids are kept. Repeated rows count each. An empty table gives no
files and an empty result. Extra columns are left out. A last document without a separator counts if it has tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from slotwise.llm import bpe
from slotwise.llm.common import chosen, gathered, small_batches, stored

END = 50256  # <|endoftext|>
KEY_TOKENS, KEY_BITS = 5, 15
NO_KEY = [0, 0, 0, 0, 1024]  # of a document without an id; no 64-bit id has these digits
DOCS_PER_FILE = 8000
BLOCK_TOKENS = 1 << 20
KIND = np.dtype("<u2")


def key_tokens(key: int | None) -> np.ndarray:
    """An id in digits that are never the end-of-document id; the last one holds the sign."""
    if key is None:
        return np.array(NO_KEY, KIND)
    return np.array([(key >> (KEY_BITS * n)) & (2**KEY_BITS - 1) for n in range(KEY_TOKENS)], KIND)


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, text: str = "text", key: str = "doc_id",
    docs_per_file: int = DOCS_PER_FILE,
) -> None:
    """Encode every text and write the token files, without a shuffle. Control strings in texts are ordinary text."""
    small_batches(docs.sparkSession)
    rows = chosen(docs, key=key, text=text)
    content = docs.sparkSession.sparkContext.broadcast(bpe.read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in gathered(batches, "text", bpe.BLOCK_BYTES):
            encoder = encoder or bpe.Encoder(content.value, added=False)
            ids = encoder.encode(batch.column("text").to_pylist())
            keys = batch.column("key").to_pylist()
            for low in range(0, len(ids), 500):
                part = [
                    np.concatenate([key_tokens(k), i.astype(KIND)]).tobytes()
                    for k, i in zip(keys[low:low + 500], ids[low:low + 500])
                ]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary())], ["tokens"])

    tokens = rows.mapInArrow(run, "tokens binary")
    separator = np.array([END], KIND).tobytes().decode("latin-1")
    tokens.select(F.col("tokens").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option(
        "lineSep", separator).option("maxRecordsPerFile", docs_per_file).text(path)


def pieces(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the pieces of a block between its separators; one more than it has separators."""
    at = np.flatnonzero(block == END)
    starts = np.r_[0, at + 1]
    return starts, np.r_[at, len(block)] - starts


def scan(spark: SparkSession, path: str, with_keys: bool = True, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document: file, number in the file, n_tokens, first_token (where it starts), and doc_id of its key."""
    small_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    skipped = KEY_TOKENS if with_keys else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                tokens = np.frombuffer(content.as_buffer(), KIND)
                for low in range(0, len(tokens), block_tokens):
                    block = tokens[low:low + block_tokens]
                    starts, sizes = pieces(block)
                    n = len(starts)
                    heads = [block[s:s + min(skipped, z)].tolist() for s, z in zip(starts.tolist(), sizes.tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * n, pa.string()), pa.array([low // block_tokens] * n, pa.int64()),
                        pa.array(np.arange(n), pa.int64()), pa.array(starts + low, pa.int64()),
                        pa.array(sizes, pa.int64()), pa.array(heads, pa.list_(pa.int32())),
                        pa.array(np.r_[np.ones(n - 1, bool), False], pa.bool_()),
                    ], ["file", "block", "place", "start", "size", "head", "ended"])

    found = stored(files.mapInArrow(
        run, "file string, block long, place long, start long, size long, head array<int>, ended boolean"), "token-pieces")
    blocks = found.groupBy("file", "block").agg(F.count_if("ended").alias("ends"))
    # Separators before each block: a prefix scan over one row per block of a file.
    before = W.Window.partitionBy("file").orderBy("block").rowsBetween(W.Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("ahead"))
    numbered = found.join(offsets, ["file", "block"]).withColumn("number", F.col("ahead") + F.col("place"))
    whole = numbered.groupBy("file", "number").agg(
        F.sum("size").alias("size"), F.min("start").alias("start"), F.max("ended").alias("ended"),
        F.slice(F.flatten(F.transform(
            F.sort_array(F.collect_list(F.struct("block", "head"))), lambda x: x["head"])), 1, max(skipped, 1)).alias("head"),
    ).filter("ended or size > 0")
    digits = [F.shiftleft(F.get("head", F.lit(n)).cast("long"), KEY_BITS * n) for n in range(KEY_TOKENS)]
    value = F.when(F.col("head") != F.array(*map(F.lit, NO_KEY)), reduce(lambda x, y: x.bitwiseOR(y), digits))
    return whole.select(
        "file", "number", (F.col("size") - skipped).alias("n_tokens"), (F.col("start") + skipped).alias("first_token"),
        *([value.alias("doc_id")] if with_keys else []),
    )


def totals(counts: DataFrame) -> DataFrame:
    """Tokens and documents of each file."""
    return counts.groupBy("file").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

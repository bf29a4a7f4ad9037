"""Documents that hold benchmark items: SimHash windows of each item's size, Hamming blocks, exact similarity.

An item and a window are multisets of five-word shingles (ASCII letters lower-cased). Windows of as many shingles as an
item has slide over every document by one word; a shorter document is one window. A similarity of ``least`` needs that
share of a window's shingles to belong to items of its size, which a bit map of fixed size tells without a miss; windows
that pass get a 64-bit SimHash weighted by shingle counts. Two fingerprints within ``RADIUS`` bits agree on one of
RADIUS + 1 blocks at least, so windows and items meet by size, block and block value. What is within the radius is
compared exactly, by weighted Jaccard similarity of the shingles.

Items of fewer than five words hold no shingle and match nothing. Null texts and items match nothing. Items with equal texts
are one class, reported by its smallest id and its size. Equal rows (same id and text) are reported once; rows without an
id are reported without one. Extra columns are left out. Empty tables give an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import chosen, gathered, in_arrow, small_batches, stored, text_key
from slotwise.llm.words import SHINGLE, mixed, runs, similarity, words_of

LEAST = 0.8
#: At a similarity of LEAST a bit differs with probability 0.15; 19 of 64 is 3.4 standard deviations above the mean.
BITS, RADIUS = 64, 19
MAP_BITS = 1 << 22
MAP_PART = 32768  # bits of one value of Spark's bitmap functions
MOST_SIZES = 5000
ANY_SIZE = 0
BATCH_BYTES = 1_000_000
SIZE_STEP = np.uint64(0x9FB21C651E98DF25)


def simhash(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of the windows of ``size`` shingles that begin at ``starts``; repeated shingles weigh as often."""
    signs = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    sums = np.zeros((len(hashes) + 1, BITS), np.int32)
    np.cumsum(signs, axis=0, out=sums[1:])
    return np.packbits(sums[starts + size] - sums[starts] > 0, axis=1).view(np.int64).reshape(-1)


def counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(hashes, return_counts=True)


def blocks(fingerprint: Column) -> Column:
    """Number and value of each of RADIUS + 1 blocks of bits."""
    cuts = [BITS * n // (RADIUS + 1) for n in range(RADIUS + 2)]
    return F.array(*(
        F.struct(F.lit(n).alias("block"), F.shiftrightunsigned(fingerprint, low).bitwiseAND((1 << (high - low)) - 1).alias("bits"))
        for n, (low, high) in enumerate(zip(cuts, cuts[1:]))
    ))


def indexed(items: DataFrame, text: str = "text", key: str = "item_id") -> DataFrame:
    """One row per distinct item text: item, item_id, n_items, size (shingles), fingerprint, shingles."""
    small_batches(items.sparkSession)
    rows = chosen(items, key=key, text=text, item=text_key(items[f"`{text}`"]))
    rows = rows.groupBy("item").agg(F.min("key").alias("item_id"), F.count("*").alias("n_items"), F.first("text").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", BATCH_BYTES):
            words = words_of(batch.column("text"), lower=True)
            hashes, at = runs(words, SHINGLE)
            cuts = np.searchsorted(at, words.firsts)
            own = [hashes[a:b] for a, b in zip(cuts, cuts[1:])]
            kept = [i for i, h in enumerate(own) if len(h)]
            prints = [int(simhash(own[i], np.array([0]), len(own[i]))[0]) for i in kept]
            columns = [batch.column(n).take(pa.array(kept, pa.int64())) for n in ("item", "item_id", "n_items")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([len(own[i]) for i in kept], pa.int32()), pa.array(prints, pa.int64()),
                 pa.array([own[i].tobytes() for i in kept], pa.binary())],
                ["item", "item_id", "n_items", "size", "fingerprint", "shingles"])

    return in_arrow(
        rows, run, f"item binary, item_id {kind}, n_items long, size int, fingerprint long, shingles binary")


def shingle_map(index: DataFrame) -> np.ndarray:
    """Bits of all shingles of the items, alone and with the item's size. The map's own size does not depend on how many items there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, value in zip(batch.column("size").to_pylist(), batch.column("shingles").to_pylist()):
                own = np.frombuffer(value, "<u8")
                at = np.unique(np.r_[slots(own, size), slots(own, ANY_SIZE)])
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], ["at"])

    positions = in_arrow(index.select("size", "shingles"), run, "at long").withColumn("at", F.col("at") + 1)
    parts = positions.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    out = np.zeros(MAP_BITS, bool)
    for p in parts:
        low = (p["part"] - 1) * MAP_PART
        out[low:low + MAP_PART] = np.unpackbits(np.frombuffer(p["bits"], np.uint8), bitorder="little")
    return np.packbits(out)


def slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """Where a shingle of a window of ``size`` shingles stands in the bit map."""
    return (mixed(hashes ^ (np.uint64(size) * SIZE_STEP)) % np.uint64(MAP_BITS)).astype(np.int64)


def windows(docs: DataFrame, index: DataFrame, text: str = "text", key: str = "doc_id", least: float = LEAST) -> DataFrame:
    """Windows that may hold an item: row, doc_id, size, start (word), fingerprint, shingles."""
    spark = docs.sparkSession
    small_batches(spark)
    sizes = [r["size"] for r in index.select("size").distinct().limit(MOST_SIZES + 1).collect()]
    if len(sizes) > MOST_SIZES:
        raise ValueError(f"items of more than {MOST_SIZES} different sizes")
    shared = spark.sparkContext.broadcast((sorted(sizes), shingle_map(index)))
    name = docs[f"`{key}`"]
    row = F.concat_ws(" ", F.coalesce(name.cast("string"), F.lit("null")), F.md5(docs[f"`{text}`"]))
    rows = chosen(docs, row=row, key=key, text=text).filter("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, packed = shared.value
        known = np.unpackbits(packed).astype(bool) if lengths else None
        for batch in gathered(batches, "text", BATCH_BYTES) if lengths else ():
            words = words_of(batch.column("text"), lower=True)
            hashes, at = runs(words, SHINGLE)
            cuts = np.searchsorted(at, words.firsts)
            out = []
            # Of most texts, too few shingles belong to any item at all.
            least_needed = int(np.ceil(least * lengths[0] - 1e-9))
            hits = np.r_[0, np.cumsum(known[slots(hashes, ANY_SIZE)])]
            for i in np.flatnonzero(hits[cuts[1:]] - hits[cuts[:-1]] >= least_needed).tolist():
                own = hashes[cuts[i]:cuts[i + 1]]
                for size in lengths:
                    need = int(np.ceil(least * size - 1e-9))
                    if len(own) < need:
                        break
                    span = min(size, len(own))
                    inside = np.r_[0, np.cumsum(known[slots(own, size)])]
                    starts = np.flatnonzero(inside[span:] - inside[:len(own) - span + 1] >= need)
                    prints = simhash(own, starts, span) if len(starts) else ()
                    out += [(i, size, int(s), int(f), own[s:s + span].tobytes()) for s, f in zip(starts, prints)]
            if out:
                owner, size, start, prints, own = zip(*out)
                at_row = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(at_row), batch.column("key").take(at_row), pa.array(size, pa.int32()),
                     pa.array(start, pa.int32()), pa.array(prints, pa.int64()), pa.array(own, pa.binary())],
                    ["row", "key", "size", "start", "fingerprint", "shingles"])

    kind = rows.schema["key"].dataType.simpleString()
    return in_arrow(rows, run, f"row string, key {kind}, size int, start int, fingerprint long, shingles binary")


def contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", least: float = LEAST,
) -> DataFrame:
    """A row for each document and item text it holds: row, key, item_id, n_items, similarity, first_word, n_windows."""
    index = stored(indexed(items), "benchmark")
    found = stored(windows(docs, index, text, key, least), "windows")
    # Rows that are equal in id and text have equal windows.
    seen = found.select("row", "size", "start", "fingerprint").distinct()
    theirs = index.select("item", "size", F.col("fingerprint").alias("other"), F.explode(blocks(F.col("fingerprint"))).alias("b"))
    ours = seen.withColumn("b", F.explode(blocks(F.col("fingerprint"))))
    near = ours.join(theirs.select("item", "size", "other", "b"), ["size", "b"]).filter(
        F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= RADIUS)
    pairs = near.select("row", "size", "start", "item").distinct()
    one = found.dropDuplicates(["row", "size", "start"]).select("row", "key", "size", "start", "shingles")
    rows = pairs.join(one, ["row", "size", "start"]).join(index.select("item", F.col("shingles").alias("wanted")), "item")
    kind = found.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ours, theirs = ([counted(np.frombuffer(v, "<u8")) for v in batch.column(c).to_pylist()] for c in ("shingles", "wanted"))
            alike = np.array([similarity(a, b) for a, b in zip(ours, theirs)])
            kept = pa.array(np.flatnonzero(alike >= least))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(kept) for c in ("row", "key", "item", "start")), pa.array(alike[alike >= least], pa.float64())],
                ["row", "key", "item", "start", "similarity"])

    exact = in_arrow(
        rows.select("row", "key", "item", "start", "shingles", "wanted"), run,
        f"row string, key {kind}, item binary, start int, similarity double")
    best = exact.groupBy("row", "item").agg(
        F.first("key").alias("key"), F.max(F.struct("similarity", (-F.col("start")).alias("minus"))).alias("best"),
        F.count("*").alias("n_windows"))
    return best.join(index.select("item", "item_id", "n_items"), "item").select(
        "row", F.col("key").alias(key), "item_id", "n_items", F.col("best.similarity").alias("similarity"),
        (-F.col("best.minus")).cast("long").alias("first_word"), "n_windows")


def clean(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents that hold no item, whole and unchanged."""
    found = contaminated(docs, items, text, key).select(F.col("row").alias("__row")).distinct()
    row = F.concat_ws(" ", F.coalesce(docs[f"`{key}`"].cast("string"), F.lit("null")), F.md5(docs[f"`{text}`"]))
    return docs.join(found, row == F.col("__row"), "left_anti")

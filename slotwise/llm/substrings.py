"""Removal of passages that also stand in an earlier document, by windows dealt by their smallest prefix.

A window is ``length`` (13) consecutive words of one document; words are what space and U+0009 to U+000D separate. Every
word covered by a window whose words also start in a document with a smaller id is removed; windows are judged on the
input.

No suffix tree is built: windows are grouped by hashes. A window belongs to the place of its smallest run of five words by
hash, so equal windows always choose the same place, and neighbouring windows mostly share one, in one entry. The five words
are the prefix by which entries are dealt to buckets, whose number follows the size of the input. Windows are counted first,
by hash of the prefix. Where one prefix (or several of one hash) outgrows a bucket's share, its windows are dealt further, by
prefix, place and fingerprint, to as many parts as it has shares; equal windows stay together. In a bucket, windows of one
prefix, place and fingerprint in two documents or more are a repeat, all its documents but the smallest lose the words, and
neighbouring windows join to maximal repeats. Each block of texts first settles its own repeats and sends a window once, for
its smallest document, so that a passage in a third of all documents is a few rows.

Null texts have no words. Rows without an id keep all their words and remove nothing elsewhere. Rows of one id and equal
texts get equal results; of one id and different texts, each is judged alone, and neither is smaller than the other.
Extra columns are left out unless kept. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.llm.common import chosen, gathered, in_arrow, small_batches
from slotwise.llm.words import STEP_WORDS, Words, long_hash, mixed, runs, words_of

LENGTH, PREFIX = 13, 5
#: Bytes of text that a worker holds at once; its arrays take about 30 times as much.
BLOCK_BYTES = 4_000_000
#: Bytes of text whose windows make one bucket on average, and whose documents make one bucket of results.
BUCKET_BYTES, RESULT_BYTES = 8_000_000, 8_000_000
#: Prefixes are counted by hash in so many slots a bucket.
SLOTS = 4
NEVER = np.uint64(2**64 - 1)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, their bytes by significance, so that small and sorted numbers cost little."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    head = np.array([len(a) for a in arrays], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def unpack(value: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    sizes = np.frombuffer(raw, "<u4", len(kinds))
    out, at = [], 4 * len(kinds)
    for kind, n in zip(map(np.dtype, kinds), sizes.tolist()):
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


ENTRY = ("<u8", "<i8", "<u4", "<u4", "u1", "u1", "<u4")  # prefix, document, tag, start, reach, windows; then fingerprints
FOUND = ("<i8", "<u4", "<u4", "<u4")  # document, tag, start, windows


def anchors(words: Words, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window, where its smallest prefix stands (words from its start), and that prefix."""
    hashes, at = runs(words, PREFIX)
    by_place = np.full(len(words.hashes) + length, NEVER)
    by_place[at] = hashes
    best, reach = by_place[starts], np.zeros(len(starts), np.uint8)
    for k in range(1, length - PREFIX + 1):
        other = by_place[starts + k]
        lower = other < best
        best = np.where(lower, other, best)
        reach[lower] = k
    return best, reach


def joined_runs(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and size of each run of consecutive starts in one document (ordered by both)."""
    first = np.flatnonzero(np.r_[True, (np.diff(start) != 1) | (doc[1:] != doc[:-1])][:len(start)])
    return first, np.diff(np.r_[first, len(start)])


def block_windows(texts: pa.Array, ids: np.ndarray, tags: np.ndarray, length: int) -> tuple[np.ndarray, ...] | None:
    """Windows of a block by smallest id: row, start in the row, start in the block, fingerprint and smallest document, and
    the words, ids and tags in that order; none if there are no windows."""
    order = np.argsort(ids, kind="stable")
    ids, tags = ids[order], tags[order]
    words = words_of(texts.take(pa.array(order)))
    prints, starts = runs(words, length)
    if not len(prints):
        return None
    row = np.searchsorted(words.firsts, starts, side="right") - 1
    local = (starts - words.firsts[row]).astype("<u4")
    doc = ids[row]
    # Equal windows side by side, those of the smallest document first.
    by_print = np.argsort(prints, kind="stable")
    new = np.r_[True, np.diff(prints[by_print]) != 0]
    smallest = np.empty(len(doc), np.int64)
    smallest[by_print] = doc[by_print][np.flatnonzero(new)[np.cumsum(new) - 1]]
    return row, local, starts, prints, smallest, words, ids, tags


def slot_of(prefix: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(prefix) % np.uint64(SLOTS * buckets)).astype(np.int64)


def block_counts(texts: pa.Array, ids: np.ndarray, tags: np.ndarray, length: int, buckets: int) -> np.ndarray:
    """Number of windows that a block of texts sends on, by slot of their prefix."""
    found = block_windows(texts, ids, tags, length)
    if found is None:
        return np.zeros(SLOTS * buckets, np.int64)
    row, _, starts, _, smallest, words, ids, _ = found
    prefix, _ = anchors(words, starts[ids[row] == smallest], length)
    return np.bincount(slot_of(prefix, buckets), minlength=SLOTS * buckets)


Heavy = tuple[np.ndarray, np.ndarray]  # slots in order, number of parts of each
NONE_HEAVY: Heavy = (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def heavy_slots(slots: np.ndarray, counts: np.ndarray, share: float) -> Heavy:
    """The slots that hold more windows than a bucket's share, and in how many parts they are dealt."""
    order = np.argsort(slots)
    slots, counts = np.asarray(slots, np.int64)[order], np.asarray(counts, np.int64)[order]
    over = counts > share
    return slots[over], np.ceil(counts[over] / max(share, 1)).astype(np.uint64)


def parts_of(prefix: np.ndarray, reach: np.ndarray, prints: np.ndarray, buckets: int, heavy: Heavy) -> np.ndarray:
    """The part of each window: 0, and in a heavy slot a hash of prefix, place and fingerprint."""
    part = np.zeros(len(prefix), np.uint64)
    if len(heavy[0]):
        slot = slot_of(prefix, buckets)
        at = np.minimum(np.searchsorted(heavy[0], slot), len(heavy[0]) - 1)
        hot = np.flatnonzero(heavy[0][at] == slot)
        path = mixed(prefix[hot] + reach[hot].astype(np.uint64) * STEP_WORDS)
        part[hot] = mixed(path + prints[hot].astype("<u4").astype(np.uint64)) % heavy[1][at[hot]]
    return part


def block_entries(
    texts: pa.Array, ids: np.ndarray, tags: np.ndarray, length: int, buckets: int, results: int, heavy: Heavy = NONE_HEAVY,
) -> Iterator[tuple[int, int, bytes]]:
    """Bucket, kind (0: entries, 1: repeats settled here) and value of what a block of texts sends on."""
    windows = block_windows(texts, ids, tags, length)
    if windows is None:
        return
    row, local, starts, prints, smallest, words, ids, tags = windows
    doc = ids[row]
    settled = np.flatnonzero(doc > smallest)
    if len(settled):
        first, size = joined_runs(row[settled], local[settled])
        at = settled[first]
        yield from by_result(ids[row[at]], tags[row[at]], local[at], size.astype("<u4"), results)
    sent = np.flatnonzero(doc == smallest)
    prefix, reach = anchors(words, starts[sent], length)
    part = parts_of(prefix, reach, prints[sent], buckets, heavy)
    place = starts[sent] + reach
    first = np.flatnonzero(np.r_[True, (np.diff(place) != 0) | (np.diff(starts[sent]) != 1) | (part[1:] != part[:-1])])
    size = np.diff(np.r_[first, len(sent)])
    # Entries by bucket and prefix; each brings its windows' fingerprints along.
    # The parts of a prefix go to neighbouring buckets, no two of them to one.
    bucket = ((mixed(prefix[first]) % np.uint64(buckets) + part[first]) % np.uint64(buckets)).astype(np.int64)
    ranked = np.lexsort((prefix[first], bucket))
    first, size, bucket = first[ranked], size[ranked], bucket[ranked]
    ends = np.cumsum(size)
    flat = np.repeat(first - (ends - size), size) + np.arange(ends[-1])
    low_prints = prints[sent].astype("<u4")[flat]
    at = sent[first]
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket) != 0, True])
    for a, b in zip(cuts, cuts[1:]):
        w0, w1 = (ends - size)[a], ends[b - 1]
        yield int(bucket[a]), 0, pack(
            prefix[first[a:b]], ids[row[at[a:b]]].astype("<i8"), tags[row[at[a:b]]], local[at[a:b]], reach[first[a:b]],
            size[a:b].astype("u1"), low_prints[w0:w1])


def by_result(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, size: np.ndarray, results: int) -> Iterator[tuple]:
    """Repeats as (bucket of the document, 1, value)."""
    bucket = np.mod(long_hash(doc), results)
    order = np.lexsort((start, doc, bucket))
    doc, tag, start, size, bucket = doc[order], tag[order], start[order], size[order], bucket[order]
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket) != 0, True])
    for a, b in zip(cuts, cuts[1:]):
        yield int(bucket[a]), 1, pack(doc[a:b], tag[a:b], start[a:b], size[a:b])


def bucket_repeats(values: list[bytes], results: int) -> Iterator[tuple[int, int, bytes]]:
    """The repeats that one bucket's entries show."""
    prefix, doc, tag, start, reach, size, prints = (
        np.concatenate(x) for x in zip(*(unpack(v, *ENTRY) for v in values)))
    size = size.astype(np.int64)
    owner = np.repeat(np.arange(len(size)), size)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    # A path: the prefix, how far the window reaches to its left, the fingerprint of all its words.
    path = mixed(prefix[owner] + (reach[owner].astype(np.int64) - step).astype(np.uint64) * STEP_WORDS)
    order = np.lexsort((doc[owner], prints, path))
    same = (path[order][1:] == path[order][:-1]) & (prints[order][1:] == prints[order][:-1])
    new = np.r_[True, ~same]
    smallest = np.empty(len(owner), np.int64)
    smallest[order] = doc[owner][order][np.flatnonzero(new)[np.cumsum(new) - 1]]
    found = np.flatnonzero(doc[owner] > smallest)
    if len(found):
        first, length = joined_runs(owner[found], step[found])
        at = found[first]
        yield from by_result(doc[owner[at]], tag[owner[at]], start[owner[at]] + step[at].astype("<u4"),
                             length.astype("<u4"), results)


def without(texts: pa.Array, ids: list, tags: np.ndarray, found: dict, length: int) -> tuple[list[str], list[int], list[int]]:
    """Kept words joined by one space, number of words and of removed words of each text."""
    words = words_of(texts)
    n = len(words.hashes)
    cover = np.zeros(n + 1, np.int32)
    for i, (key, tag) in enumerate(zip(ids, tags.tolist())):
        spans = found.get((key, tag))
        if spans is not None:
            np.add.at(cover, words.firsts[i] + spans[0], 1)
            np.add.at(cover, words.firsts[i] + spans[0] + spans[1] + (length - 1), -1)
    removed = np.cumsum(cover[:n]) > 0
    kept = np.flatnonzero(~removed)
    sizes = words.ends[kept] - words.starts[kept] + 1
    ends = np.cumsum(sizes)
    flat = np.repeat(words.starts[kept] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    out = np.r_[words.data, np.uint8(32)][np.minimum(flat, len(words.data))]
    out[ends - 1] = 32
    out = out.tobytes()
    bounds = np.r_[0, ends][np.searchsorted(kept, words.firsts)].tolist()
    pieces = [out[a:max(a, b - 1)].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]
    gone = np.r_[0, np.cumsum(removed)]
    return pieces, np.diff(words.firsts).tolist(), np.diff(gone[words.firsts]).tolist()


def remove_repeats(
    docs: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = (), length: int = LENGTH,
) -> DataFrame:
    """``key``, the ``keep`` columns, ``kept`` (the words left, joined by one space), ``n_words`` and ``n_removed``."""
    if not PREFIX < length <= 200:
        raise ValueError(f"windows of {PREFIX + 1} to 200 words")
    spark = docs.sparkSession
    small_batches(spark, most=BLOCK_BYTES)
    names = [f"k{n}" for n in range(len(keep))]
    rows = chosen(docs, id=docs[f"`{key}`"].cast("long"), text=text, **dict(zip(names, keep)))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, results = int(size // BUCKET_BYTES) + 1, int(size // RESULT_BYTES) + 1
    # Texts are told apart by a tag only where ids are not unique; elsewhere the tag is 0 and costs nothing.
    shared = rows.select("id", F.xxhash64("text").alias("h")).groupBy("id").agg(
        F.min("h").alias("low"), F.max("h").alias("high")).filter("id is not null and low != high")
    tag = F.lit(0) if shared.isEmpty() else F.xxhash64("text").bitwiseAND(2**31 - 1).cast("int")
    tagged = rows.withColumn("tag", tag)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        for batch in gathered(batches, "text", BLOCK_BYTES):
            ids, tags = batch.column("id").to_numpy(zero_copy_only=False), batch.column("tag").to_numpy()
            yield batch.column("text"), ids, tags.astype("<u4")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS * buckets, np.int64)
        for block in blocks(batches):
            total += block_counts(*block, length, buckets)
        slots = np.flatnonzero(total)
        for a in range(0, len(slots), 100_000):
            at = slots[a:a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            held = []
            for item in block_entries(*block, length, buckets, results, heavy):
                held.append(item)
                if len(held) == 64:
                    yield sent(held)
                    held = []
            if held:
                yield sent(held)

    def sent(items: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        bucket, kind, value = zip(*items)
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int64()), pa.array(kind, pa.int32()), pa.array(value, pa.binary())],
            ["bucket", "kind", "value"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, values = None, []
        for batch in batches:
            for bucket, kind, value in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "value"))):
                if kind == 1:
                    yield sent([(bucket, kind, value)])
                    continue
                if bucket != now and values:
                    if out := list(bucket_repeats(values, results)):
                        yield sent(out)
                    values = []
                now = bucket
                values.append(value)
        if values and (out := list(bucket_repeats(values, results))):
            yield sent(out)

    parts = "bucket long, kind int, value binary"
    told = tagged.select("id", "tag", "text").filter("id is not null and text is not null")
    heavy = NONE_HEAVY
    if buckets > 1:
        counted = in_arrow(told, count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).persist()
        share = (counted.agg(F.sum("n")).first()[0] or 0) / buckets
        # At most as many as there are buckets, as each holds more than a share.
        over = counted.filter(F.col("n") > share).collect()
        counted.unpersist()
        heavy = heavy_slots(np.array([r["slot"] for r in over], np.int64), np.array([r["n"] for r in over], np.int64), share)
    entries = in_arrow(told, send, parts)
    # Kind first: repeats pass through, then each bucket's entries come together.
    by_bucket = entries.repartition(F.col("bucket")).sortWithinPartitions(F.col("kind").desc(), "bucket")
    repeats = in_arrow(by_bucket, settle, parts).select("bucket", F.lit(0).alias("kind"), "value")
    home = F.pmod(F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("id")), F.lit(results))
    blank = [F.lit(None).cast(tagged.schema[n].dataType).alias(n) for n in ("id", "tag", "text", *names)]
    both = repeats.select("bucket", "kind", "value", *blank).unionAll(tagged.select(
        home.alias("bucket"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("value"), "id", "tag", "text", *names))
    at_home = both.repartition(F.col("bucket")).sortWithinPartitions("bucket", "kind")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, values, found = None, [], {}
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            cuts = np.flatnonzero(np.r_[True, np.diff(bucket) != 0, True])
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                if bucket[a] != now:
                    now, values, found = bucket[a], [], {}
                part = batch.slice(a, b - a)
                kind = part.column("kind").to_numpy()
                values.extend(part.column("value").filter(pa.array(kind == 0)).to_pylist())
                if not (kind == 1).any():
                    continue
                if values:
                    found, values = spans_by_document(values), []
                part = part.filter(pa.array(kind == 1))
                pieces, n_words, n_removed = without(
                    part.column("text"), part.column("id").to_pylist(), part.column("tag").to_numpy(), found, length)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *(part.column(n) for n in names), pa.array(pieces, pa.string()),
                     pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                    ["id", *names, "kept", "n_words", "n_removed"])

    schema = T.StructType([tagged.schema["id"], *(tagged.schema[n] for n in names)])
    for name, kind in (("kept", T.StringType()), ("n_words", T.LongType()), ("n_removed", T.LongType())):
        schema.add(name, kind)
    out = in_arrow(at_home, finish, schema)
    return out.select(F.col("id").alias(key), *(F.col(n).alias(k) for n, k in zip(names, keep)), "kept", "n_words", "n_removed")


def spans_by_document(values: list[bytes]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Starts and numbers of windows of each document's repeats."""
    doc, tag, start, size = (np.concatenate(x) for x in zip(*(unpack(v, *FOUND) for v in values)))
    order = np.lexsort((tag, doc))
    doc, tag, start, size = doc[order], tag[order], start[order].astype(np.int64), size[order].astype(np.int64)
    cuts = np.flatnonzero(np.r_[True, (np.diff(doc) != 0) | (np.diff(tag.astype(np.int64)) != 0), True])
    return {(int(doc[a]), int(tag[a])): (start[a:b], size[a:b]) for a, b in zip(cuts, cuts[1:])}

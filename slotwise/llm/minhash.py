"""Near-duplicate classes of documents by DartMinHash signatures of their weighted word shingles.

A document is a multiset of five-word shingles (ASCII letters lower-cased). Darts are thrown at each unit of a shingle's
weight: a hash chain gives the dart's times, one after the other, and each dart falls on one of 252 coordinates. All darts
up to a time that gives about ``k ln k + 2k`` of them are thrown, whatever the document's size; a coordinate keeps its
earliest. Two documents agree on a coordinate with the probability of their weighted Jaccard similarity.

Coordinates are joined in 42 bands of 6 (two texts of similarity 0.8 share none with a probability of 3 in a million). In
each bucket of a band, and of two neighbouring bands together, every text is compared with the bucket's first; links
are exact weighted similarities of ``least`` or more between the texts themselves. What these links leave apart inside a
bucket is then compared across classes, block against block: the texts bring their shingles along, a meeting of two blocks
finds the exact similarity of every two of different classes, and reports a spanning forest of the links between the classes,
so fewer rows than the blocks have texts. So a class misses no link that any bucket holds. Equal texts are one node
from the start, and a class is a connected component of links.

Null texts count as empty; all empty texts are equal, so they are one class. Texts of fewer than five words have one
shingle. Repeated rows are members each; rows without an id belong to classes and never name one unless all its rows lack
an id. Extra columns are left out. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import chosen, discard, gathered, in_arrow, small_batches, stored, text_key
from slotwise.llm.components import components
from slotwise.llm.words import mixed, shingles, similarity, weighted, words_of

COORDINATES, BANDS = 252, 42
LEAST = 0.8
#: Most texts and bytes of shingles in a block, on average, and shingles that a meeting of two blocks compares at once.
BLOCK, BLOCK_BYTES, SLAB = 256, 2_000_000, 4096
BATCH_BYTES = 1_000_000
#: Texts whose darts are held at once: a text takes about as many however short it is.
DART_TEXTS = 500
STEP = np.uint64(0xD1B54A32D192ED03)


def darts(
    hashes: np.ndarray, weights: np.ndarray, owners: np.ndarray, n: int, k: int = COORDINATES,
) -> np.ndarray:
    """Signatures (n rows of k 64-bit numbers) of weighted sets given as elements with an owner each.

    Weights are any positive numbers: each unit of weight is a region of its own, the last one may be partly covered,
    and darts beside the covered part are not kept. Owners without elements get zeros.
    """
    cells = np.ceil(weights).astype(np.int64)
    element = np.repeat(np.arange(len(hashes)), cells)
    unit = np.arange(len(element)) - np.repeat(np.cumsum(cells) - cells, cells)
    region = mixed(hashes[element] + unit.astype(np.uint64) * STEP)
    covered = np.minimum(weights[element] - unit, 1.0)
    owner = owners[element]
    total = np.bincount(owners, weights, n)
    out = np.zeros((n, k), np.uint64)
    missing = total > 0
    thrown = k * np.log(k) + 2 * k
    while missing.any():
        at = np.flatnonzero(missing[owner])
        limit = thrown / np.maximum(total, 1e-12)
        seed, time = region[at], np.zeros(len(at))
        best = np.full(n * k, np.inf)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(at):
            seed = mixed(seed + STEP)
            time = time - np.log1p(-((seed >> np.uint64(11)) * 2.0**-53))
            early = time <= limit[owner[at]]
            at, seed, time = at[early], seed[early], time[early]
            more = mixed(seed ^ STEP)
            hit = (more & np.uint64(0xFFFFFFFF)) * 2.0**-32 < covered[at]
            place = owner[at] * k + ((more >> np.uint64(32)) % np.uint64(k)).astype(np.int64)
            place, when, name = place[hit], time[hit], seed[hit]
            np.minimum.at(best, place, when)
            held.append((place, when, name))
        flat = out.reshape(-1)
        for place, when, name in held:
            first = when == best[place]
            flat[place[first]] = name[first]
        missing &= np.isinf(best.reshape(n, k)).any(axis=1)
        thrown *= 2
    return out


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A number for each band of each signature."""
    parts = signatures.reshape(len(signatures), bands, -1)
    keys = np.zeros(parts.shape[:2], np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * STEP
    for j in range(parts.shape[2]):
        keys = mixed(keys ^ parts[:, :, j])
    return keys.view(np.int64)


def text_bands(hashes: np.ndarray, weights: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Band keys of n texts (shingles ordered by text), few texts at a time."""
    keys = np.zeros((n, BANDS), np.int64)
    for low in range(0, n, DART_TEXTS):
        high = min(low + DART_TEXTS, n)
        a, b = np.searchsorted(owners, [low, high])
        keys[low:high] = band_keys(darts(hashes[a:b], weights[a:b].astype(float), owners[a:b] - low, high - low))
    return keys


def signed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``node`` (the text's key), ``bands`` and ``size`` (number of shingles) of every distinct text."""
    small_batches(docs.sparkSession, most=4 * BLOCK_BYTES)
    rows = chosen(docs, node=text_key(docs[f"`{text}`"]), text=text).filter("length(text) > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", BATCH_BYTES):
            texts = batch.column("text")
            hashes, owners, weights = weighted(*shingles(words_of(texts, lower=True)))
            worded = np.isin(np.arange(len(texts)), owners)
            keys, size = text_bands(hashes, weights, owners, len(texts)), np.bincount(owners, weights, len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("node"), pa.array([k.tolist() if w else [] for k, w in zip(keys, worded)], pa.list_(pa.int64())),
                pa.array(size),
            ], ["node", "bands", "size"])

    found = in_arrow(rows, run, "node binary, bands array<long>, size long")
    return found.groupBy("node").agg(F.first("bands").alias("bands"), F.first("size").alias("size"))


def shingle_sets(texts: DataFrame) -> DataFrame:
    """``node`` and ``shingles`` of every row: its shingles as sorted 64-bit numbers, the n-th place of one as a number of its own.

    So two of these sets have as Jaccard similarity the weighted one of the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", BATCH_BYTES):
            n = len(batch)
            hashes, owners, weights = weighted(*shingles(words_of(batch.column("text"), lower=True)))
            ends = np.cumsum(weights)
            nth = np.arange(weights.sum()) - np.repeat(ends - weights, weights)
            numbers, owner = mixed(np.repeat(hashes, weights) + nth.astype(np.uint64) * STEP), np.repeat(owners, weights)
            numbers = numbers[np.lexsort((numbers, owner))].astype("<u8")
            cuts = np.searchsorted(owner, np.arange(n + 1)).tolist()
            sets = [numbers[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])

    return in_arrow(texts.select("node", "text"), run, "node binary, shingles binary")


def verified(pairs: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs (a, b) whose texts have an exact weighted similarity of ``least`` or more, with it."""
    sides = [texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"]
    rows = pairs.join(sides[0], "a").join(sides[1], "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text_a", BATCH_BYTES):
            sets = []
            for side in ("text_a", "text_b"):
                column = batch.column(side)
                hashes, owners, weights = weighted(*shingles(words_of(column, lower=True)))
                cuts = np.searchsorted(owners, np.arange(len(column) + 1))
                sets.append([(hashes[i:j], weights[i:j]) for i, j in zip(cuts, cuts[1:])])
            alike = np.array([similarity(x, y) for x, y in zip(*sets)])
            kept = pa.array(np.flatnonzero(alike >= least))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(kept), batch.column("b").take(kept), pa.array(alike[alike >= least], pa.float64())],
                ["a", "b", "similarity"],
            )

    return in_arrow(rows.select("a", "b", "text_a", "text_b"), run, "a binary, b binary, similarity double")


def alike(one: list[bytes], two: list[bytes] | None, least: float = LEAST) -> np.ndarray:
    """For each set of ``one`` and of ``two`` (none: ``one`` again) whether their similarity is ``least`` or more."""
    sides = []
    for sets in (one,) if two is None else (one, two):
        size = np.array([len(s) // 8 for s in sets])
        sides.append((np.frombuffer(b"".join(sets), "<u8"), np.repeat(np.arange(len(sets)), size), size))
    if two is None:
        values, times = np.unique(sides[0][0], return_counts=True)
        shared, sides = values[times > 1], sides * 2
    else:
        shared = np.intersect1d(sides[0][0], sides[1][0])
    both = np.zeros((len(sides[0][2]), len(sides[1][2])))
    if len(shared):
        # What both sides hold, by its number; a slab of them at a time is a product of two matrices of zeros and ones.
        found = []
        for numbers, owner, size in sides:
            at = np.minimum(np.searchsorted(shared, numbers), len(shared) - 1)
            hit = shared[at] == numbers
            order = np.argsort(at[hit], kind="stable")
            found.append((at[hit][order], owner[hit][order], len(size)))
        for low in range(0, len(shared), SLAB):
            held = []
            for at, owner, n in found:
                a, b = np.searchsorted(at, [low, low + SLAB])
                part = np.zeros((n, min(SLAB, len(shared) - low)), np.float32)
                part[owner[a:b], at[a:b] - low] = 1
                held.append(part)
            both += held[0] @ held[1].T
    total = sides[0][2][:, None] + sides[1][2][None] - both
    return both / np.maximum(total, 1) >= least


def forest(pairs: np.ndarray, n: int) -> list[int]:
    """The places of those pairs that join what the pairs before them leave apart, among ``n`` classes."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for place, (x, y) in enumerate(pairs.tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            kept.append(place)
    return kept


def across_classes(
    shared: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, least: float = LEAST,
    scratch: list[str] | None = None,
) -> DataFrame:
    """Links (a, b) between texts of one bucket but different classes, enough to join all classes that have any.

    A bucket's texts are dealt to blocks of about BLOCK texts or BLOCK_BYTES of shingles, a large class of its own to blocks
    that hold nothing else, and each block meets each other one of its bucket, unless both hold the same class. A
    meeting compares exactly, and reports at most one link less than it holds classes.
    """
    named = nodes.select("node", "size").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = shared.select("key", "node").join(named, "node")
    # How many blocks a class of a bucket fills; those that fill none of their own share the bucket's mixed blocks.
    share = F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES)
    held = placed.groupBy("key", "label").agg(F.count("*").alias("n"), (F.sum("size") * 8).alias("bytes"))
    held = held.select("key", "label", share.alias("share"))
    torn = held.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.sum(F.when(F.col("share") < 1, F.col("share")).otherwise(0)).alias("mixed"),
    ).filter("low != high")
    dealt = held.join(torn.select("key", "mixed"), "key")
    members = stored(placed.join(dealt, ["key", "label"]).select(
        "key", "node", "label",
        F.when(F.col("share") >= 1, F.col("label")).alias("own"),
        F.pmod(F.xxhash64("node"), F.ceil(F.greatest(F.when(F.col("share") >= 1, F.col("share")).otherwise(F.col("mixed")),
                                                     F.lit(1)))).alias("part"),
    ), "torn", scratch)
    sets = shingle_sets(texts.join(members.select("node").distinct(), "node", "left_semi"))
    blocks = stored(members.join(sets, "node").groupBy("key", F.xxhash64("own", "part").alias("block")).agg(
        F.collect_list(F.struct("node", "label", "shingles")).alias("rows"),
        F.min("label").alias("low"), F.max("label").alias("high")), "blocks", scratch)
    one = blocks.select("key", "block", "rows", F.expr("if(low = high, low, null)").alias("only"))
    two = one.select("key", F.col("block").alias("other"), F.col("rows").alias("more"), F.col("only").alias("alone"))
    meetings = one.join(two, "key").filter("block <= other and not coalesce(only = alone, false)").select(
        F.col("block") == F.col("other"), "rows", "more").toDF("same", "rows", "more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column("same")[k].as_py()
                sides = [batch.column(c)[k].values for c in (("rows",) if same else ("rows", "more"))]
                node, label, held = (
                    [side.field(c).to_pylist() for side in sides] for c in ("node", "label", "shingles"))
                number = {x: i for i, x in enumerate(sorted({x for side in label for x in side}))}
                kinds = [np.array([number[x] for x in side]) for side in label]
                links = alike(held[0], None if same else held[1], least) & (kinds[0][:, None] != kinds[-1][None])
                i, j = np.nonzero(links)
                x, y = kinds[0][i], kinds[-1][j]
                _, first = np.unique(np.minimum(x, y) * len(number) + np.maximum(x, y), return_index=True)
                kept = first[forest(np.c_[x, y][first], len(number))] if len(first) else first
                a, b = ([nodes[p] for p in at[kept].tolist()] for nodes, at in ((node[0], i), (node[-1], j)))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return in_arrow(meetings, run, "a binary, b binary").distinct()


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", least: float = LEAST) -> DataFrame:
    """``key``, ``class_id`` (the smallest ``key`` of the class) and ``class_size`` of every row."""
    scratch: list[str] = []
    nodes = stored(signed(docs, text), "signatures", scratch)
    members = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = members.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    shared = stored(members.join(buckets, "key"), "buckets", scratch)
    # Two neighbouring bands together: finer buckets, whose first texts are closer to the others.
    pair = F.pmod("band", F.lit(2))
    fine = shared.groupBy("node", F.floor(F.col("band") / 2).alias("place")).agg(
        F.min(F.when(pair == 0, F.col("key"))).alias("even"), F.min(F.when(pair == 1, F.col("key"))).alias("odd"),
    ).na.drop()
    first_of = fine.groupBy("even", "odd").agg(F.min("node").alias("hub"))
    closer = fine.join(first_of, ["even", "odd"]).select("node", "hub")
    stars = stored(shared.select("node", "hub").unionAll(closer).filter("node != hub").select(
        F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "stars", scratch)
    wanted = shared.select("node").distinct()
    texts = stored(
        chosen(docs, node=text_key(docs[f"`{text}`"]), text=text).join(wanted, "node", "left_semi").dropDuplicates(["node"]),
        "candidates", scratch)
    links = stored(verified(stars, texts, least), "links", scratch)
    labels = components(links, scratch=scratch)
    more = stored(across_classes(shared, labels, nodes, texts, least, scratch), "links", scratch)
    if not more.isEmpty():
        labels = components(links.select("a", "b").unionAll(more), scratch=scratch)
    owned = chosen(docs, key=key, node=text_key(docs[f"`{text}`"]))
    named = owned.join(labels, "node", "left").select("key", F.coalesce("label", "node").alias("label"))
    named = stored(named, "membership")
    discard(docs.sparkSession, scratch)
    heads = named.groupBy("label").agg(F.min("key").alias("class_id"), F.count("*").alias("class_size"))
    return named.join(heads, "label").select(F.col("key").alias(key), "class_id", "class_size")

"""Document fingerprints that do not depend on the order of paragraphs and can be updated.

A paragraph is a line that is not blank. It hashes (SHAKE-256) to a wide vector; a document's state is the sum of its
paragraphs' vectors, each lane modulo a power of two. The state has two parts: 1024 lanes of 16 bits, which tell
multisets of paragraphs apart, and 1024 lanes that get plus or minus one from each paragraph, modulo 2**32; squared
differences of the latter estimate how many paragraphs two documents do not share. Adding or removing paragraphs adds or
subtracts their vectors. The fingerprint is the SHA-256 of the state.

A line is the smallest unit: a document of one paragraph that is edited anywhere shares no paragraph with its edited text, so
their likeness is about 0 even if half of its words are kept, and does not tell it from an unrelated document.

Null and empty texts have the zero state; two documents without paragraphs are alike (1.0). Repeated rows and ties in
``doc_id`` are ordered by the text's key, rows without a ``doc_id`` come last in descending order. Extra columns are left
out. An empty table gives an empty table; a table of one row is its own next document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from slotwise.llm.common import chosen, gathered, small_batches, stored, text_key

LANES = 1024
WIDE_BYTES, SIGN_BYTES = 2 * LANES, LANES // 8
SLAB = 4096  # paragraphs whose vectors are held at a time
BATCH_BYTES = 1_000_000


def paragraphs(text: str | None) -> list[bytes]:
    return [p.encode("utf-8", "surrogatepass") for p in (text or "").split("\n") if not p.isspace() and p]


def vectors(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 16-bit lanes and the signs of each paragraph."""
    raw = b"".join(hashlib.shake_256(p).digest(WIDE_BYTES + SIGN_BYTES) for p in parts)
    table = np.frombuffer(raw, np.uint8).reshape(len(parts), WIDE_BYTES + SIGN_BYTES)
    wide = np.ascontiguousarray(table[:, :WIDE_BYTES]).view("<u2")
    signs = 1 - 2 * np.unpackbits(table[:, WIDE_BYTES:], axis=1).astype(np.int8)
    return wide, signs


def states(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The state of each text: an array of 16-bit sums and one of 32-bit sums, a row for each text."""
    numbers: dict[bytes, int] = {}
    lists = [[numbers.setdefault(p, len(numbers)) for p in paragraphs(t)] for t in texts]
    unique = list(numbers)
    wide = np.zeros((len(lists), LANES), "<u2")
    signs = np.zeros((len(lists), LANES), "<i4")
    owners = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    flat = np.fromiter((n for x in lists for n in x), np.int64, len(owners))
    # Slabs of the distinct paragraphs bound what is held, however long a text is.
    for low in range(0, len(unique), SLAB):
        w, s = vectors(unique[low:low + SLAB])
        here = np.flatnonzero((flat >= low) & (flat < low + SLAB))
        for at in range(0, len(here), SLAB):
            part = here[at:at + SLAB]
            cuts = np.flatnonzero(np.r_[True, np.diff(owners[part]) != 0])
            rows = flat[part] - low
            wide[owners[part][cuts]] += np.add.reduceat(w[rows], cuts, axis=0, dtype=np.uint16)
            signs[owners[part][cuts]] += np.add.reduceat(s[rows], cuts, axis=0, dtype=np.int32)
    return wide, signs


def fingerprint(wide: np.ndarray, signs: np.ndarray) -> str:
    return hashlib.sha256(wide.astype("<u2").tobytes() + signs.astype("<i4").tobytes()).hexdigest()


def changed(state: tuple[np.ndarray, np.ndarray], added: str = "", removed: str = "") -> tuple[np.ndarray, np.ndarray]:
    """A state after paragraphs came and went, without the document's other paragraphs."""
    (w, s), (plus_w, plus_s), (less_w, less_s) = state, *([x[0] for x in states([t])] for t in (added, removed))
    return w + plus_w - less_w, s + plus_s - less_s


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 less the share of paragraphs (squared counts) that only one of two documents has, row by row, from the signs."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    both = (a * a).sum(axis=1) + (b * b).sum(axis=1)
    apart = ((a - b) ** 2).sum(axis=1)
    return np.where(both == 0, 1.0, np.clip(1 - apart / np.where(both == 0, 1, both), 0, 1))


def edited(text: str, following: str) -> str:
    """The last half of a text's code points replaced by as many of the next text's first."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double"
)


def _compared(texts: list[str], following: list[str], own: tuple, after: tuple) -> list[list]:
    """The result columns of texts, given the states of the texts and of those that follow them."""
    changed_texts = [edited(a, b) for a, b in zip(texts, following)]
    wide, signs = states(changed_texts)
    return [
        [len(t) for t in texts],
        [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed_texts],
        [fingerprint(w, s) for w, s in zip(*own)],
        [fingerprint(w, s) for w, s in zip(wide, signs)],
        likeness(own[1], signs).tolist(),
        likeness(own[1], after[1]).tolist(),
    ]


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``fingerprint`` and the state (``wide``, ``signs`` as little-endian bytes) of each text."""
    small_batches(docs.sparkSession)
    rows = chosen(docs, key=key, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", BATCH_BYTES):
            wide, signs = states(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([
                batch.column("key"), pa.array([fingerprint(w, s) for w, s in zip(wide, signs)], pa.string()),
                pa.array([w.tobytes() for w in wide], pa.binary()), pa.array([s.tobytes() for s in signs], pa.binary()),
            ], ["key", "fingerprint", "wide", "signs"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, fingerprint string, wide binary, signs binary").withColumnRenamed("key", key)


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, which ends with the start of the next document.

    One range shuffle puts documents in descending order of ``doc_id``. A task compares neighbours as they pass; its
    first and last documents are written out, and meet the neighbouring tasks' in a join of one row per task.
    """
    small_batches(docs.sparkSession)
    rows = chosen(docs, key="doc_id", text=F.coalesce(docs["`text`"], F.lit("")), tie=text_key(docs["`text`"]))
    order = [F.col("key").desc_nulls_last(), F.col("tie")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    id_type = rows.schema["key"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        arrow_id = None

        def out(keys, columns, edge=None, texts=None):
            n = len(keys)
            filled = columns or [[None] * n] * 6
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, arrow_id), *map(pa.array, filled, kinds), pa.array([edge] * n, pa.string()),
                 pa.array([task] * n, pa.int32()), pa.array(texts or [None] * n, pa.string())],
                ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                 "edge", "task", "text"],
            )

        held = None
        for batch in gathered(batches, "text", BATCH_BYTES):
            arrow_id = batch.schema.field("key").type
            keys, texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
            own = states(texts)
            if held is None:
                yield out(keys[:1], None, "first", texts[:1])
            else:
                keys, texts = [held[0], *keys], [held[1], *texts]
                own = tuple(np.concatenate([h[None], o]) for h, o in zip(held[2], own))
            if len(texts) > 1:
                yield out(keys[:-1], _compared(
                    texts[:-1], texts[1:], tuple(o[:-1] for o in own), tuple(o[1:] for o in own)))
            held = keys[-1], texts[-1], tuple(o[-1] for o in own)
        if held:
            yield out([held[0]], None, "last", [held[1]])

    schema = T.StructType([T.StructField("key", id_type)])
    for f in T._parse_datatype_string(f"{RESULT}, edge string, task int, text string").fields:
        schema.add(f)
    parts = stored(ordered.mapInArrow(run, schema), "fingerprints")
    tasks = parts.filter("edge = 'first'").select("task")
    # A row for each task: after the last one comes the first.
    around = W.Window.orderBy("task")
    following = tasks.select(
        "task", F.coalesce(
            F.lead("task").over(around),
            F.first("task").over(around.rowsBetween(W.Window.unboundedPreceding, W.Window.unboundedFollowing)),
        ).alias("next_task"),
    )
    first = parts.filter("edge = 'first'").select(F.col("task").alias("next_task"), F.col("text").alias("next_text"))
    last = parts.filter("edge = 'last'").select("task", "key", "text")
    edges = last.join(following, "task").join(first, "next_task").select("key", "text", "next_text")

    def compare_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", BATCH_BYTES):
            texts, after = batch.column("text").to_pylist(), batch.column("next_text").to_pylist()
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *map(pa.array, _compared(texts, after, states(texts), states(after)), kinds)],
                ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    result = T.StructType(schema.fields[:7])
    done = parts.filter("edge is null").select(*result.fieldNames())
    return done.unionAll(edges.mapInArrow(compare_edges, result)).withColumnRenamed("key", "doc_id")

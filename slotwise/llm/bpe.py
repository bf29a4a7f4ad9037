"""Byte-pair encoding and decoding with a public byte-level vocabulary.

``encode`` gives the ids of every whole text, ``decode`` the texts of id lists. Texts are cut into pre-tokens; the
distinct pre-tokens of a block of a partition are encoded together with a pair occurrence index: every adjacent pair
that a merge rule knows has a list of the places where it stands. Active ranks are applied in ascending order, each to
all its places at once, and the lists of the pairs to the left and right of each merge are updated.

Null and empty texts have no ids. Strings of added tokens (``<|endoftext|>``) in a text become those tokens. Repeated
rows are encoded each on its own; extra columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import chosen, gathered, in_arrow, small_batches

# The pattern that cuts texts before byte-level merges, and the bytes that stand for themselves.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

BLOCK_BYTES = 8_000_000
NEVER = np.int32(2**31 - 1)


class Vocabulary:
    """Merge rules and token bytes of a byte-level BPE file."""

    def __init__(self, content: str) -> None:
        data = json.loads(content)
        ids = data["model"]["vocab"]
        others = (b for b in range(256) if b not in set(PLAIN_BYTES))
        byte_of = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + n): b for n, b in enumerate(others)}
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.size = max([*ids.values(), *self.added.values()]) + 1
        self.pieces = [b""] * self.size
        for token, i in ids.items():
            self.pieces[i] = bytes(byte_of[c] for c in token)
        for token, i in self.added.items():
            self.pieces[i] = token.encode()
        self.of_byte = np.zeros(256, np.int32)
        for c, b in byte_of.items():
            self.of_byte[b] = ids[c]
        rules = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        left = np.array([ids[a] for a, _ in rules], np.int64)
        right = np.array([ids[b] for _, b in rules], np.int64)
        self.made = np.array([ids[a + b] for a, b in rules], np.int32)
        self.twins = left == right
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_ranks = keys[order], order.astype(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or NEVER."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.key_ranks[at], NEVER)


def _by_rank(places: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(ranks, kind="stable")
    places, ranks = places[order], ranks[order]
    cuts = np.flatnonzero(np.diff(ranks)) + 1
    if len(places):
        yield from zip(ranks[np.r_[0, cuts]].tolist(), np.split(places, cuts))


def merged(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after the other, and where each word's ids start (one more than words)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    symbols = vocab.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    n = len(symbols)
    after = np.arange(1, n + 1, dtype=np.int32)
    before = np.arange(-1, n - 1, dtype=np.int32)
    after[ends[sizes > 0] - 1] = -1
    before[(ends - sizes)[sizes > 0]] = -1
    alive = np.ones(n, bool)
    rank_at = np.full(n, NEVER, np.int32)
    pairs = np.flatnonzero(after >= 0)
    rank_at[pairs] = vocab.ranks(symbols[pairs], symbols[pairs + 1])
    index: dict[int, list[np.ndarray]] = defaultdict(list)
    known = pairs[rank_at[pairs] != NEVER]
    for rank, places in _by_rank(known, rank_at[known]):
        index[rank].append(places)
    active = list(index)
    heapq.heapify(active)
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank, None)
        if lists is None:
            continue
        places = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        places = places[rank_at[places] == rank]
        if vocab.twins[rank] and len(places) > 1:
            # In a run of equal symbols every second pair overlaps the one before it.
            starts = np.r_[True, after[places[:-1]] != places[1:]]
            first = np.maximum.accumulate(np.where(starts, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - first) % 2 == 0]
        if not len(places):
            continue
        gone = after[places]
        following = after[gone]
        symbols[places] = vocab.made[rank]
        after[places] = following
        has_next = following >= 0
        before[following[has_next]] = places[has_next]
        alive[gone] = False
        rank_at[gone] = NEVER
        previous = before[places]
        rank_at[places[~has_next]] = NEVER
        touched = np.concatenate([places[has_next], previous[previous >= 0]])
        touched = touched[alive[touched]]
        new = vocab.ranks(symbols[touched], symbols[after[touched]])
        rank_at[touched] = new
        for later, at in _by_rank(touched[new != NEVER], new[new != NEVER]):
            if later not in index:
                heapq.heappush(active, later)
            index[later].append(at)
    kept = np.r_[0, np.cumsum(alive)]
    return symbols[alive], kept[np.r_[0, ends]]


class Encoder:
    """Encodes lists of texts; the distinct pre-tokens of one call share one pair index.

    Without ``added`` the strings of added tokens are ordinary text.
    """

    def __init__(self, content: str, added: bool = True) -> None:
        self.vocab = Vocabulary(content)
        if not added:
            self.vocab.added = {}
        self.pattern = regex.compile(PRE_TOKENS)
        strings = sorted(self.vocab.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, strings)) + ")") if strings else None

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens; an added token stands alone (no pre-token mixes letters and signs, so none equals it)."""
        if self.added is None or not any(a in text for a in self.vocab.added):
            return self.pattern.findall(text)
        out = []
        for n, part in enumerate(self.added.split(text)):
            out.extend([part] if n % 2 else self.pattern.findall(part))
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        number: dict[str, int] = defaultdict(count().__next__)
        places = []
        for text in texts:
            found = self.pre_tokens(text) if text else []
            places.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
        words = list(number)
        number.clear()
        special = [i for i, w in enumerate(words) if w in self.vocab.added]
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        for i in special:
            raw[i] = b""
        ids, starts = merged(raw, self.vocab)
        if special:
            ids = np.insert(ids, starts[special], [self.vocab.added[words[i]] for i in special])
            ahead = np.zeros(len(starts), np.int64)
            ahead[np.array(special) + 1] = 1
            starts = starts + np.cumsum(ahead)
        ids, sizes = ids.astype("<u4"), np.diff(starts)
        out = []
        for at in places:
            lengths = sizes[at]
            total = int(lengths.sum())
            shift = np.repeat(starts[at] - (np.cumsum(lengths) - lengths), lengths)
            out.append(ids[shift + np.arange(total)])
        return out


def read_vocabulary(path: str) -> str:
    """The vocabulary file's content; read once by the driver, a few megabytes by its format."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoded(batch: pa.RecordBatch, encoder: Encoder) -> Iterator[pa.RecordBatch]:
    """``key`` and ``ids`` of a batch with ``key`` and ``text``, in parts, so that the next step's batches stay small."""
    done = 0
    ids = encoder.encode(batch.column("text").to_pylist())
    while done < len(ids):
        part = ids[done:done + 1000]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key").slice(done, len(part)), pa.array([i.tobytes() for i in part], pa.binary())],
            ["key", "ids"],
        )
        done += len(part)


def decoded(ids: pa.Array, pieces: list[bytes]) -> pa.Array:
    """The bytes of each row's tokens as text."""
    return pa.array([
        b"".join(map(pieces.__getitem__, np.frombuffer(i or b"", "<u4").tolist())).decode("utf-8", "replace")
        for i in ids.to_pylist()
    ], pa.string())


def encode(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``ids`` (little-endian unsigned 32-bit integers, one row per row of ``docs``)."""
    small_batches(docs.sparkSession)
    rows = chosen(docs, key=key, text=text)
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in gathered(batches, "text", BLOCK_BYTES):
            encoder = encoder or Encoder(content.value)
            yield from encoded(batch, encoder)

    kind = rows.schema["key"].dataType.simpleString()
    return in_arrow(rows, run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode(tokens: DataFrame, vocabulary: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """The ``keep`` columns and ``decoded``: the bytes of the ids' tokens as text, broken UTF-8 replaced.

    Null ids give an empty text; ids outside the vocabulary are an error.
    """
    small_batches(tokens.sparkSession)
    rows = tokens.select(*(tokens[f"`{k}`"] for k in keep), tokens[f"`{ids}`"].alias("__ids"))
    content = tokens.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        for batch in batches:
            pieces = pieces or Vocabulary(content.value).pieces
            kept = [c for c in batch.schema.names if c != "__ids"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), decoded(batch.column("__ids"), pieces)], [*kept, "decoded"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__ids")
    return in_arrow(rows, run, f"{schema}, decoded string")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of what they decode to.

    Encoded and decoded in one step, so that a task needs one Python worker and reads the vocabulary once.
    """
    small_batches(docs.sparkSession)
    rows = chosen(docs, key="doc_id", text="text")
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in gathered(batches, "text", BLOCK_BYTES):
            encoder = encoder or Encoder(content.value)
            for part in encoded(batch, encoder):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, decoded(part.column("ids"), encoder.vocab.pieces)], ["key", "ids", "decoded"])

    kind = rows.schema["key"].dataType.simpleString()
    return in_arrow(rows, run, f"key {kind}, ids binary, decoded string").select(
        F.col("key").alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )

"""Language identification with a byte convolutional network, trained in numpy on labelled rows.

A text's UTF-8 bytes are cut into windows of a fixed length, the last one padded with zero bytes. A window's bytes are
embedded; filters of several widths run over it, the largest answer of each filter is kept, and a softmax over these
gives a probability for each language. A text's probabilities are the mean over all its windows, by their length.

The network is fitted on at most ``per_language`` rows of each language (expected; never more than four times that), drawn
by a hash among the rows that may be learned from, with a few windows of each. Prediction sees nothing but the text.
Null texts and texts without a letter are ``und`` with score 0, and so is everything if there is nothing to learn from. Rows
whose ``doc_id`` is null are not learned from and not held out. Repeated rows are predicted each; extra columns are left
out; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import chosen, gathered, in_arrow, small_batches

WINDOW = 256
WIDTHS, FILTERS, DEPTH = (2, 3, 4), 24, 6
PER_LANGUAGE, WINDOWS_PER_ROW, MOST_LANGUAGES = 600, 4, 500
EPOCHS, BATCH, RATE = 6, 32, 0.004
CHUNK = 64  # windows computed at a time, so that what they need stays in the processor's cache
UNKNOWN = "und"


@dataclass
class Network:
    """Embedding of bytes, filters per width, and the last layer."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        normal = lambda *shape: rng.standard_normal(shape).astype(np.float32)
        return cls(
            languages, normal(256, DEPTH) * np.float32(0.5),
            [normal(w * DEPTH, FILTERS) * np.float32((w * DEPTH) ** -0.5) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            normal(len(WIDTHS) * FILTERS, len(languages)) * np.float32(0.1), np.zeros(len(languages), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.weights, self.bias]

    def pooled(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """The largest answer of each filter in each window, cut at zero; with ``where``, also the places of those."""
        embedded = self.embedding[windows]
        n, length = windows.shape
        tops, places = [], []
        for width, kernel, bias in zip(WIDTHS, self.filters, self.biases):
            steps = length - width + 1
            patches = np.lib.stride_tricks.as_strided(
                embedded, (n, steps, width * DEPTH), embedded.strides[:2] + embedded.strides[2:],
            ).reshape(n * steps, width * DEPTH)
            answers = (patches @ kernel).reshape(n, steps, FILTERS)
            if where:
                at = answers.argmax(axis=1)
                places.append(at)
                tops.append(np.take_along_axis(answers, at[:, None], axis=1)[:, 0] + bias)
            else:
                tops.append(answers.max(axis=1) + bias)
        return np.maximum(np.concatenate(tops, axis=1), 0), places

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for low in range(0, len(windows), CHUNK):
            pooled, _ = self.pooled(windows[low:low + CHUNK])
            out[low:low + CHUNK] = softmax(pooled @ self.weights + self.bias)
        return out

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy, in the order of ``parameters``."""
        pooled, places = self.pooled(windows, where=True)
        back = softmax(pooled @ self.weights + self.bias)
        back[np.arange(len(labels)), labels] -= 1
        back /= len(labels)
        to_pooled = (back @ self.weights.T) * (pooled > 0)
        to_embedding = np.zeros_like(self.embedding)
        to_filters, to_biases = [], []
        rows = np.arange(len(windows))[:, None]
        for k, (width, kernel) in enumerate(zip(WIDTHS, self.filters)):
            signal = to_pooled[:, k * FILTERS:(k + 1) * FILTERS]
            # Only the bytes under a filter's largest answer take part.
            seen = np.stack([windows[rows, places[k] + j] for j in range(width)], axis=2)
            patches = self.embedding[seen].reshape(len(windows), FILTERS, width * DEPTH)
            to_filters.append(np.einsum("nf,nfp->pf", signal, patches))
            to_biases.append(signal.sum(axis=0))
            spread = signal[:, :, None] * kernel.T[None]
            np.add.at(to_embedding, seen.reshape(-1), spread.reshape(-1, DEPTH))
        return [to_embedding, *to_filters, *to_biases, pooled.T @ back, back.sum(axis=0)]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, the number of the text each belongs to, and the bytes each holds."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    padded = b"".join(t + bytes(-len(t) % WINDOW) for t in texts)
    windows = np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)
    owners = np.repeat(np.arange(len(texts)), counts)
    sizes = np.full(len(windows), WINDOW, np.float64)
    last = np.cumsum(counts) - 1
    for t, n, at in zip(texts, counts, last):
        if n:
            sizes[at] = len(t) - WINDOW * (n - 1)
    return windows, owners, sizes


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> Network:
    """Fit a network (Adam) to labelled windows."""
    languages = sorted(set(labels))
    net = Network.fresh(languages, seed)
    windows = np.frombuffer(b"".join(t[:WINDOW].ljust(WINDOW, b"\0") for t in texts), np.uint8).reshape(-1, WINDOW)
    targets = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(windows))
        for low in range(0, len(order), BATCH):
            part = order[low:low + BATCH]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
            for p, g, (m, v) in zip(net.parameters(), net.gradients(windows[part], targets[part]), moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = PER_LANGUAGE,
) -> Network | None:
    """Train on a bounded sample of the labelled rows that are not held out; None if there are none."""
    rows = chosen(docs, key=key, text=text, lang=lang).filter(
        "key is not null and lang is not null and length(text) > 0").filter(~held_out(F.col("key")))
    counts = rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return None
    shares = F.create_map(*(x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, per_language / r["count"])))))
    drawn = F.pmod(F.xxhash64("key", "text"), F.lit(1_000_000)) < F.element_at(shares, F.col("lang")) * 1_000_000
    spare = F.greatest(F.length("text") - WINDOW, F.lit(0))
    pieces = F.array(*(
        F.substring(F.col("text"), (spare * (n / max(1, WINDOWS_PER_ROW - 1))).cast("int") + 1, F.lit(WINDOW))
        for n in range(WINDOWS_PER_ROW)
    ))
    sample = rows.filter(drawn).select("lang", F.array_distinct(pieces).alias("pieces"), F.xxhash64("key").alias("h"))
    found = sample.limit(4 * per_language * len(counts)).collect()
    found.sort(key=lambda r: (r["h"], r["lang"]))
    pairs = [(p.encode("utf-8", "replace"), r["lang"]) for r in found for p in r["pieces"]]
    return train([t for t, _ in pairs], [x for _, x in pairs]) if pairs else None


def predict(docs: DataFrame, net: Network | None, keep: dict[str, str], text: str = "text") -> DataFrame:
    """The ``keep`` columns (new name: column) with ``lang_pred`` and ``score`` for the whole text of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = chosen(docs, **keep, __text=text)
    model = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = regex.compile(r"\p{L}")
        network = model.value
        for batch in gathered(batches, "__text", 2_000_000):
            texts = batch.column("__text").to_pylist()
            known = [i for i, t in enumerate(texts) if network and t and letter.search(t)]
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known:
                windows, owners, sizes = cut([texts[i].encode("utf-8", "replace") for i in known])
                weighted = network.probabilities(windows) * sizes[:, None]
                firsts = np.flatnonzero(np.r_[True, np.diff(owners) > 0])
                sums = np.add.reduceat(weighted, firsts, axis=0)
                sums /= sums.sum(axis=1, keepdims=True)
                for i, best, row in zip(known, sums.argmax(axis=1), sums):
                    langs[i], scores[i] = network.languages[best], float(row[best])
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*names, "lang_pred", "score"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return in_arrow(rows, run, f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Predicted language of every document, learned from those that are not held out."""
    out = predict(docs, fit(docs), {"doc_id": "doc_id"})
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

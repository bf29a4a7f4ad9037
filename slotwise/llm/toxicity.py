"""Toxicity with a factorization machine over hashed terms, trained in numpy on labelled rows.

A text's terms are its distinct words (runs of letters, lower-cased) and, so that inflected and invented forms of a stem
share what is learned, the first four, five and six letters of longer words. Terms are hashed to 32 bits and present or
not: a text's answer is a bias, the sum of its terms' weights, and the mean over its terms of their pairwise products of
latent vectors, which the usual identity (square of the sum less sum of the squares) gives without listing pairs. A term
that means nothing alone, such as a group's name, can so raise the answer beside an insult. Weights are fitted by Adagrad
with an L1 penalty, so that the many terms of a long clean text weigh nothing; a fifth of the sample, kept from the fit,
sets slope and offset of the final logistic.

The machine is fitted on at most ``per_label`` rows of each label (expected; never more than four times that) of at most
``MOST_CHARS`` code points each, drawn by a hash among the rows that may be learned from. What is broadcast is the terms of
that sample, whatever the input's size. Scoring reads every whole text, in blocks of bounded size.

Null and empty texts have no terms: they get the score of the bias alone. If one of the labels 0 and 1 is missing among the
rows to learn from, every score is 0. Of several labels of one document the largest counts; labels without ``doc_id`` or
``toxic`` are left out. Rows whose ``doc_id`` is null are not learned from and not held out. Repeated rows are scored each;
extra columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import chosen, gathered, small_batches

RANK = 8
STEMS = (4, 5, 6)
PER_LABEL, MOST_CHARS, LEAST_ROWS = 2500, 200_000, 4
EPOCHS, BATCH, RATE, L1, L2 = 6, 32, 0.1, 0.003, 0.001
CALIBRATION_SHARE = 0.2
TOXIC_FROM = 0.7
BLOCK = 2_000_000  # bytes of text scored at a time
CHUNK = 1_000_000  # code points of one text taken apart at a time
MOST_WORDS_KNOWN = 200_000

WORD = re.compile(r"[^\W\d_]+")
BREAK = re.compile(r"[\W\d_]")


def chunks(text: str) -> Iterator[str]:
    """The text in pieces of bounded length that cut no word shorter than a piece."""
    start = 0
    while len(text) - start > CHUNK:
        at = BREAK.search(text, start + CHUNK // 2, start + CHUNK)
        end = at.end() if at else start + CHUNK
        yield text[start:end]
        start = end
    yield text[start:]


class Terms:
    """Hashed terms of texts, or, given a vocabulary, the places in it of those that it holds. Known words are kept."""

    def __init__(self, vocabulary: np.ndarray | None = None) -> None:
        self.known: dict[str, tuple[int, ...]] = {}
        self.places = None if vocabulary is None else {t: i for i, t in enumerate(vocabulary.tolist())}

    def of_word(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            stems = [f"^{word[:n]}" for n in STEMS if len(word) > n]
            found = tuple(zlib.crc32(t.encode("utf-8", "replace")) for t in (word, *stems))
            if self.places is not None:
                found = tuple(self.places[t] for t in found if t in self.places)
            if len(self.known) >= MOST_WORDS_KNOWN:
                self.known.clear()
            self.known[word] = found
        return found

    def of_text(self, text: str | None) -> np.ndarray:
        words: set[str] = set()
        for piece in chunks(text or ""):
            words.update(WORD.findall(piece.lower()))
        terms = set(chain.from_iterable(map(self.of_word, words)))
        return np.sort(np.fromiter(terms, np.uint32, len(terms)))


def places(terms: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Places in the sorted vocabulary of those terms that it holds."""
    if not len(vocabulary):
        return np.empty(0, np.uint32)
    at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
    return at[vocabulary[at] == terms].astype(np.uint32)


def joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The places of several texts one after the other, and where each text starts."""
    flat = np.concatenate(texts) if texts else np.empty(0, np.uint32)
    return flat, np.cumsum([0, *map(len, texts)])


@dataclass
class Machine:
    """Weights and latent vectors of the known terms, and the final logistic."""

    vocabulary: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    @classmethod
    def fresh(cls, vocabulary: np.ndarray, seed: int = 7) -> Machine:
        rng = np.random.default_rng(seed)
        vectors = (rng.standard_normal((len(vocabulary), RANK)) * 0.01).astype(np.float32)
        return cls(vocabulary, 0.0, np.zeros(len(vocabulary), np.float32), vectors)

    def answers(self, at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The answer of each text, the sum of its vectors, and the row that each term belongs to."""
        n = len(starts) - 1
        sizes = np.diff(starts)
        row = np.repeat(np.arange(n), sizes)
        sums, squares = np.empty((n, RANK)), np.zeros(n)
        for k in range(RANK):
            values = self.vectors[at, k].astype(np.float64)
            sums[:, k] = np.bincount(row, values, n)
            squares += np.bincount(row, values * values, n)
        pairs = 0.5 * ((sums * sums).sum(axis=1) - squares) / np.maximum(sizes, 1)
        return self.bias + np.bincount(row, self.weights[at], n) + pairs, sums, row

    def gradients(
        self, at: np.ndarray, starts: np.ndarray, labels: np.ndarray, shares: np.ndarray | float = 1.0
    ) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Of the mean logistic loss, weighted by ``shares``: bias, then the terms that occur, their weights and vectors."""
        answers, sums, row = self.answers(at, starts)
        back = (logistic(answers) - labels) * shares / len(labels)
        terms, place = np.unique(at, return_inverse=True)
        to_weights = np.bincount(place, back[row], len(terms))
        to_pairs = (back / np.maximum(np.diff(starts), 1))[row]
        to_vectors = np.empty((len(terms), RANK))
        for k in range(RANK):
            to_vectors[:, k] = np.bincount(place, to_pairs * (sums[row, k] - self.vectors[at, k]), len(terms))
        return float(back.sum()), terms, to_weights, to_vectors

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Probabilities of texts given by the places of their terms."""
        answers = self.answers(*joined(texts))[0]
        return logistic(self.slope * answers + self.offset)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Machine:
    """Fit a machine to the terms of labelled texts, a part of which only sets its final logistic."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    aside = order[:int(len(texts) * CALIBRATION_SHARE)]
    fitted = order[len(aside):]
    if len(set(labels[fitted])) < 2:
        fitted = order
    seen, counts = np.unique(np.concatenate([texts[i] for i in fitted]), return_counts=True)
    machine = Machine.fresh(seen[counts >= LEAST_ROWS], seed)
    texts = [places(t, machine.vocabulary) for t in texts]
    ones = labels[fitted].mean()
    shares = np.where(labels == 1, 0.5 / ones, 0.5 / (1 - ones))  # both labels count the same
    steps = {
        "bias": 1e-6, "weights": np.full(len(machine.weights), 1e-6), "vectors": np.full(machine.vectors.shape, 1e-6)}
    for _ in range(EPOCHS):
        mixed = rng.permutation(fitted)
        for low in range(0, len(mixed), BATCH):
            part = mixed[low:low + BATCH]
            at, starts = joined([texts[i] for i in part])
            to_bias, terms, to_weights, to_vectors = machine.gradients(at, starts, labels[part], shares[part])
            to_weights += L2 * machine.weights[terms]
            to_vectors += L2 * machine.vectors[terms]
            steps["bias"] += to_bias ** 2
            steps["weights"][terms] += to_weights ** 2
            steps["vectors"][terms] += to_vectors ** 2
            machine.bias -= RATE * to_bias / steps["bias"] ** 0.5
            rates = RATE / np.sqrt(steps["weights"][terms])
            moved = machine.weights[terms] - rates * to_weights
            machine.weights[terms] = np.sign(moved) * np.maximum(np.abs(moved) - L1 * rates, 0)
            machine.vectors[terms] -= 0.5 * RATE * to_vectors / np.sqrt(steps["vectors"][terms])
    if len(set(labels[aside])) == 2:
        answers = machine.answers(*joined([texts[i] for i in aside]))[0]
        machine.slope, machine.offset = calibrated(answers, labels[aside])
    return machine


def calibrated(answers: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic over answers (Newton's steps, targets drawn in from 0 and 1)."""
    ones = int(labels.sum())
    targets = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.stack([answers, np.ones_like(answers)], axis=1)
    at = np.array([1.0, 0.0])
    loss = lambda c: float(np.logaddexp(0, x @ c).sum() - targets @ (x @ c))
    for _ in range(rounds):
        p = logistic(x @ at)
        slope = x.T @ (p - targets)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2)
        step, size = np.linalg.solve(curve, slope), 1.0
        while loss(at - size * step) > loss(at) and size > 1e-6:
            size /= 2
        at = at - size * step
        if np.abs(step).max() < 1e-9:
            break
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
    per_label: int = PER_LABEL,
) -> Machine | None:
    """Train on a bounded sample of the labelled rows that are not held out; None if a label is missing among them."""
    known = chosen(labels, key=key, label=label).filter("key is not null and label in (0, 1)")
    known = known.filter(~held_out(F.col("key"))).groupBy("key").agg(F.max("label").cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("label") == 1, min(1.0, per_label / counts[1])).otherwise(min(1.0, per_label / counts[0]))
    hashed = F.xxhash64("key")
    drawn = known.filter(F.pmod(hashed, F.lit(1_000_000)) < share * 1_000_000).limit(8 * per_label)
    small_batches(docs.sparkSession)
    rows = chosen(docs, key=key, text=text).filter(f"length(text) <= {MOST_CHARS}")
    # The drawn rows are at most eight times per_label.
    sample = rows.join(F.broadcast(drawn), "key").select(F.xxhash64("key", "text").alias("h"), "label", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in gathered(batches, "text", BLOCK):
            found = [terms.of_text(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("label"), pa.array(found, pa.binary())], ["h", "label", "terms"])

    found = sample.limit(8 * per_label).mapInArrow(run, "h long, label int, terms binary").toArrow()
    found = found.sort_by([("h", "ascending"), ("label", "ascending")])
    truth = np.array(found["label"].to_pylist(), np.float64)
    if len(set(truth)) < 2:
        return None
    return train([np.frombuffer(b, np.uint32) for b in found["terms"].to_pylist()], truth)


def predict(docs: DataFrame, machine: Machine | None, keep: dict[str, str], text: str = "text") -> DataFrame:
    """The ``keep`` columns (new name: column) with ``score`` and ``predicted`` for the whole text of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = chosen(docs, **keep, __text=text)
    model = spark.sparkContext.broadcast(machine)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        terms = Terms(fitted.vocabulary) if fitted else None
        for batch in gathered(batches, "__text", BLOCK):
            scores = np.zeros(batch.num_rows)
            if fitted:
                found = [terms.of_text(t) for t in batch.column("__text").to_pylist()]
                # Long texts of one block are answered a few at a time.
                for low in range(0, len(found), 256):
                    scores[low:low + 256] = fitted.scores(found[low:low + 256])
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(scores), pa.array((scores >= TOXIC_FROM).astype(np.int32))],
                [*names, "score", "predicted"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(run, f"{fields}, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out."""
    out = predict(docs, fit(docs, labels), {"doc_id": "doc_id"})
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

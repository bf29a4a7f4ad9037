import random
import zlib

import numpy as np
import pytest

from slotwise.llm import toxicity

SF = "/root/testdata/sf0.01"


def area(scores, truth):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    ones = truth == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    out = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    assert len(out) == docs.count()
    assert {k for k, r in out.items() if r.held_out} == {k for k in out if zlib.crc32(str(k).encode()) % 3 == 1}
    held = [(out[r.doc_id].score, r.toxic) for r in labels.collect() if r.doc_id in out and out[r.doc_id].held_out]
    scores, truth = np.array(held).T
    # A third of the toxic documents of this table hold no word that others share.
    assert area(scores, truth) > 0.8
    assert (scores[truth == 0] >= toxicity.TOXIC_FROM).mean() < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out.values())


def test_pairs_of_terms_are_learned():
    """An insult, or a group's name, alone is clean; both together are toxic: no sum of weights can tell."""
    rng = random.Random(4)
    filler = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)]

    def text():
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = rng.sample(filler, 3) + ["zzrude"] * insult + ["qqgroup"] * group
        rng.shuffle(words)
        return " ".join(words), float(insult and group)

    rows = [text() for _ in range(3000)]
    terms = toxicity.Terms()
    machine = toxicity.train([terms.of_text(t) for t, _ in rows], np.array([y for _, y in rows]))
    both = machine.vectors[toxicity.places(terms.of_text("zzrude"), machine.vocabulary)].sum(axis=0)
    other = machine.vectors[toxicity.places(terms.of_text("qqgroup"), machine.vocabulary)].sum(axis=0)
    assert both @ other > 0
    fresh = [text() for _ in range(400)]
    known = toxicity.Terms(machine.vocabulary)
    scores = machine.scores([known.of_text(t) for t, _ in fresh])
    assert area(scores, np.array([y for _, y in fresh])) > 0.97


def test_pairs_and_gradients_by_force():
    rng = np.random.default_rng(2)
    machine = toxicity.Machine.fresh(np.arange(12, dtype=np.uint32))
    machine.weights[:] = rng.standard_normal(12)
    machine.vectors[:] = rng.standard_normal(machine.vectors.shape)
    texts = [np.array(x, np.uint32) for x in ([0, 3, 5, 11], [], [2], [1, 2, 3, 4, 5, 6])]
    labels = np.array([1.0, 0.0, 1.0, 0.0])
    at, starts = toxicity.joined(texts)
    for answer, text in zip(machine.answers(at, starts)[0], texts):
        pairs = sum(machine.vectors[a] @ machine.vectors[b] for i, a in enumerate(text) for b in text[i + 1:])
        assert answer == pytest.approx(machine.weights[text].sum() + pairs / max(1, len(text)), rel=1e-4, abs=1e-5)

    def loss():
        p = toxicity.logistic(machine.answers(at, starts)[0])
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    _, terms, to_weights, to_vectors = machine.gradients(at, starts, labels)
    for values, found in ((machine.weights, to_weights), (machine.vectors, to_vectors)):
        for row, term in enumerate(terms):
            place = (term,) if values.ndim == 1 else (term, 3)
            was = values[place].copy()
            values[place] = was + 1e-2
            high = loss()
            values[place] = was - 1e-2
            low = loss()
            values[place] = was
            assert (high - low) / 2e-2 == pytest.approx(found[(row, *place[1:])], rel=0.02, abs=1e-3)


def test_long_texts_are_read_whole(monkeypatch):
    terms = toxicity.Terms()
    text = "plain words " * 3000 + "unique_ending"
    whole = terms.of_text(text)
    monkeypatch.setattr(toxicity, "CHUNK", 100)
    assert (terms.of_text(text) == whole).all()
    assert "".join(toxicity.chunks(text)) == text and set(terms.of_word("ending")) <= set(whole.tolist())


def test_odd_rows(spark):
    rows = [(k, f"you are a clown {k % 7}") for k in range(0, 60, 2)] + [(k, "a fine day indeed") for k in range(1, 60, 2)]
    odd = [(100, None), (101, ""), (102, "123 !"), (None, "clown"), (100, "clown clown"), (2, "you are a clown 2")]
    docs = spark.createDataFrame([(*r, 0.5, 9) for r in rows + odd], "doc_id long, text string, score double, label int")
    tags = [(k, 1 - k % 2) for k in range(60)] + [(None, 1), (3, None), (2, 0), (4, 1), (400, 1)]
    labels = spark.createDataFrame(tags, "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    blank = {r.score for r in got if r.doc_id in (101, 102)}
    assert len(blank) == 1 and not [r for r in got if r.doc_id is None][0].held_out
    score = {r.doc_id: r.score for r in got}
    assert min(score[k] for k in range(0, 60, 2)) > max(score[k] for k in range(1, 60, 2))
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
    for less in (labels.limit(0), labels.filter("toxic = 1")):
        assert {r.score for r in toxicity.score_documents(docs, less).collect()} == {0.0}

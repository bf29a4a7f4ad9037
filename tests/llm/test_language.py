import zlib

import numpy as np
import pytest

from slotwise.llm import language


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    said = dict(docs.select("doc_id", "lang").collect())
    out = language.identify(docs).collect()
    assert len(out) == len(said)
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {k for k in said if zlib.crc32(str(k).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == said[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = language.Network.fresh(["a", "b", "c"], seed=1)
    for p in net.parameters():
        p += rng.standard_normal(p.shape).astype(np.float32) * 0.05
    x = rng.integers(1, 255, (6, 40)).astype(np.uint8)
    y = np.array([0, 1, 2, 0, 1, 2])

    def loss():
        return -np.log(net.probabilities(x)[np.arange(6), y]).astype(np.float64).mean()

    for p, g in zip(net.parameters(), net.gradients(x, y)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        was = p[at].copy()
        p[at] = was + 1e-2
        high = loss()
        p[at] = was - 1e-2
        low = loss()
        p[at] = was
        assert (high - low) / 2e-2 == pytest.approx(float(g[at]), rel=0.15, abs=2e-3)


def test_windows_hold_whole_texts():
    windows, owners, sizes = language.cut([b"x" * 600, b"", b"y" * 256])
    assert owners.tolist() == [0, 0, 0, 2] and sizes.tolist() == [256, 256, 88, 256] and windows.shape == (4, 256)


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "123 !?", "en"), (None, "hello there", "en"), (3, "hello hello", None)]
    rows += [(k, "the cat sat on it", "en") for k in range(10, 30)] + [(k, "le chat est là", "fr") for k in range(30, 50)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert got[1].lang_pred == got[2].lang_pred == "und" and got[1].score == 0.0
    assert got[None].lang_pred in ("en", "fr") and not got[None].held_out
    assert got[12].lang_pred == "en" and got[33].lang_pred == "fr"
    assert language.identify(docs.limit(0)).count() == 0
    nothing = language.identify(docs.filter("lang is null")).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)

import hashlib

import numpy as np
import pytest

from slotwise.llm import fingerprints as fp


def brute(rows):
    """Ids and texts in descending order of id, each with its edited text."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        out[key] = (len(text), hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest())
    return out


def test_report_matches_a_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = fp.edit_report(docs.repartition(7)).collect()
    wanted = brute([(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()])
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == wanted
    assert len(got) == len(wanted)
    texts = dict(docs.select("doc_id", "text").collect())
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    by_id = {r.doc_id: r for r in got}
    for key in order[:60]:
        (w, s), (_, n) = (tuple(x[0] for x in fp.states([texts[k]])) for k in (key, after[key]))
        assert by_id[key].fingerprint == fp.fingerprint(w, s)
        assert by_id[key].near_next == pytest.approx(float(fp.likeness(s[None], n[None])[0]))


def test_order_does_not_matter_and_updates_agree():
    a, b, c = (tuple(x[0] for x in fp.states([t])) for t in ("x\ny\ny\n\nz", "y\nz\nx\ny", "x\ny\nz\nw"))
    assert fp.fingerprint(*a) == fp.fingerprint(*b) != fp.fingerprint(*c)
    assert fp.fingerprint(*fp.changed(a, added="w", removed="y")) == fp.fingerprint(*c)
    assert fp.fingerprint(*fp.changed(a, removed="x\ny\ny\nz")) == fp.fingerprint(*(x[0] for x in fp.states([""])))


def test_likeness_follows_shared_paragraphs():
    lines = [f"line {i}" for i in range(40)]
    _, s = fp.states(["\n".join(lines), "\n".join(lines[:30] + ["other"] * 1 + [f"new {i}" for i in range(9)]), "q", ""])
    assert fp.likeness(s[:1], s[1:2])[0] == pytest.approx(0.75, abs=0.1)
    assert fp.likeness(s[:1], s[2:3])[0] < 0.15
    assert fp.likeness(s[3:], s[3:])[0] == 1.0


def test_slabs_change_nothing(monkeypatch):
    texts = ["\n".join(f"p{i % 13}" for i in range(50)), "a\nb", None, "p3\np3"]
    whole = fp.states(texts)
    monkeypatch.setattr(fp, "SLAB", 3)
    for a, b in zip(whole, fp.states(texts)):
        assert np.array_equal(a, b)


def test_odd_rows(spark):
    rows = [(None, "x\ny", 1), (None, None, 2), (3, "é" * 5, 3), (3, "é" * 5, 4), (7, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    got = fp.edit_report(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == [
        (False, 3, 5), (False, 3, 5), (False, 7, 0), (True, 0, 0), (True, 0, 3)]
    assert fp.edit_report(docs.limit(0)).count() == 0
    one = fp.edit_report(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert fp.fingerprints(docs).filter("fingerprint is null").count() == 0

"""Each stage of the pipeline on its own input, beside plain versions."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from test_decontaminate import brute as holds_items
from test_minhash import brute as near_classes
from test_substrings import brute as without_repeats
from tokenizers import Tokenizer

import corpus_pipeline

COLUMNS = list(corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def steps(spark, sf):
    """What goes into each stage, and what comes out of the last."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs.collect())
        docs = corpus_pipeline.stored(stage(spark, docs, sf), "test")
    return [*out, docs.collect()]


def pairs(rows):
    return [(r.doc_id, r.text) for r in rows]


def test_languages_are_kept(steps):
    before, after = steps[0], steps[1]
    assert list(after[0].asDict()) == COLUMNS
    assert set(map(tuple, after)) <= set(map(tuple, before))
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    lettered = {r.doc_id for r in before if any(c.isalpha() for c in r.text)}
    assert len(gone & lettered) <= 0.01 * len(before)


def test_one_of_each_class_stays(steps):
    first = near_classes(pairs(steps[1]))
    assert sorted(r.doc_id for r in steps[2]) == sorted({c for _, c in first})
    assert set(map(tuple, steps[2])) <= set(map(tuple, steps[1]))


def test_repeats_are_removed(steps):
    wanted = {(k, kept, len(kept)) for k, _, _, kept in without_repeats(pairs(steps[2]))}
    assert {(r.doc_id, r.text, r.n_chars) for r in steps[3]} == wanted and len(steps[3]) == len(steps[2])
    assert {(r.doc_id, r.lang, r.source) for r in steps[3]} == {(r.doc_id, r.lang, r.source) for r in steps[2]}


def test_items_are_gone(spark, sf, steps):
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()
    leaks = {k for k, _, _ in holds_items(pairs(steps[3]), items)}
    assert set(map(tuple, steps[4])) == {tuple(r) for r in steps[3] if r.doc_id not in leaks}


def test_tokens(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(pairs(steps[4]))
    assert len(steps[5]) == len(texts)
    for r in steps[5]:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_empty_documents_pass_every_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), "test")
    assert docs.count() == 0


def test_odd_rows_pass_every_stage(spark, sf):
    rows = [(None, "the cat", None, None, None), (1, None, "en", "a", 3), (1, "", "en", "a", 0), (2, "the cat " * 9000, "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), "test")
    assert docs.count() <= len(rows)

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from slotwise.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", None, "aaaa aaaaaaa", "a<|endoftext|>b <|endoftext|><|endoftext|>", "  \n\n x  ", "日本語 テスト😀😀 ‍ é́",
    "\x00\x01 \x7f  x y", "'s 'T don't I'll", "!!!???... 123456 ½²", "<|endoftext|", "ſ's", "a᠎ b﻿",
]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def test_ids_match_the_library_on_odd_texts(reference):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("ab <|>'stl\n\t0é̀😀") for _ in range(60)) for _ in range(200)]
    texts += ["".join(chr(rng.randrange(0x20, 0x3000)) for _ in range(60)) for _ in range(200)]
    ours = bpe.Encoder(bpe.read_vocabulary(PATH)).encode(texts)
    for text, ids in zip(texts, ours):
        assert ids.tolist() == reference.encode(text or "", add_special_tokens=False).ids, text


def test_round_trip_needs_one_python_worker_a_task(spark, sf):
    plan = bpe.round_trip(spark.read.parquet(f"{sf}/documents.parquet"), PATH)._jdf.queryExecution().toString()
    assert plan.partition("== Physical Plan ==")[2].count("MapInArrow") == 1


def test_round_trip_of_whole_texts(spark, sf, reference):
    import hashlib

    import numpy as np

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    got = bpe.round_trip(docs, PATH).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = reference.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        read = reference.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(read.encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "a b", 3), (1, "a b", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.round_trip(docs, PATH).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 2, 2]
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0
    broken = spark.createDataFrame([(1, bytearray(b"\xe2\x00\x00\x00"))], "doc_id long, ids binary")
    assert bpe.decode(broken, PATH, ["doc_id"]).first().decoded == "�"

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

from slotwise.llm import substrings
from slotwise.llm.words import runs, words_of


def brute(rows, length=substrings.LENGTH):
    """Kept words of each (id, text), from all windows of all documents."""
    split = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    first = {}
    for k, w in split:
        for i in range(len(w) - length + 1) if k is not None else ():
            window = tuple(w[i:i + length])
            first[window] = min(k, first.get(window, k))
    out = []
    for k, w in split:
        gone = set()
        for i in range(len(w) - length + 1) if k is not None else ():
            if first[tuple(w[i:i + length])] < k:
                gone.update(range(i, i + length))
        out.append((k, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=repr)


def test_stored_documents_match_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = got(substrings.remove_repeats(docs.repartition(5)))
    assert out == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sum(r[2] for r in out) > 0


def test_small_blocks_and_buckets_change_nothing(spark, monkeypatch):
    rng = random.Random(5)
    passages = [[f"p{n}_{i}" for i in range(rng.randrange(10, 40))] for n in range(12)]
    rows = []
    for k in rng.sample(range(-500, 500), 150):
        w = []
        while len(w) < rng.randrange(1, 80):
            w += rng.choice(passages) if rng.random() < 0.6 else [rng.choice("abcdé") for _ in range(rng.randrange(1, 25))]
        rows.append((k, rng.choice([" ", "\n", "  ", "\t "]).join(w)))
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(substrings, "RESULT_BYTES", 3000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(substrings.remove_repeats(docs)) == brute(rows)
    assert got(substrings.remove_repeats(docs, length=7)) == brute(rows, 7)


def test_odd_rows(spark):
    same = " ".join(f"w{i}" for i in range(30))
    rows = [(None, same), (None, None), (1, same), (2, same + " x"), (2, "y " + same), (2, same + " x"), (3, ""), (4, " "), (5, None)]
    docs = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, kept string")
    assert got(substrings.remove_repeats(docs)) == brute(rows)
    assert substrings.remove_repeats(docs, keep=("kept",)).columns[:2] == ["doc_id", "kept"]
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def frequent_prefix():
    """Five words whose hash is so small that nearly every window around them is anchored there."""
    phrases = [[f"q{n}_{i}" for i in range(5)] for n in range(20_000)]
    hashes, _ = runs(words_of(pa.array([" ".join(p) for p in phrases])), 5)
    return phrases[int(np.argmin(hashes))]


def test_a_frequent_prefix_is_dealt_to_many_buckets(spark, monkeypatch):
    rng = random.Random(9)
    phrase, other = frequent_prefix(), lambda n: [f"o{rng.randrange(10**6)}" for _ in range(n)]
    blocks = [[" ".join(other(12) + phrase + other(12)) for _ in range(600)] for _ in range(3)]
    blocks[2][:50] = blocks[0][:50]
    ids = [np.arange(600 * n, 600 * n + 600) for n in range(3)]
    tags, buckets = np.zeros(600, "<u4"), 20

    def most(heavy):
        """Windows of the fullest bucket, and all repeats."""
        sizes, values, repeats = {}, {}, set()
        for texts, i in zip(blocks, ids):
            for bucket, kind, value in substrings.block_entries(pa.array(texts), i, tags, 13, buckets, 1, heavy):
                assert kind == 0
                values.setdefault(bucket, []).append(value)
                sizes[bucket] = sizes.get(bucket, 0) + int(substrings.unpack(value, *substrings.ENTRY)[5].sum())
        for found in values.values():
            for *_, value in substrings.bucket_repeats(found, 1):
                for d, _, start, size in zip(*substrings.unpack(value, *substrings.FOUND)):
                    repeats |= {(int(d), int(start) + k) for k in range(size)}
        return max(sizes.values()), sum(sizes.values()) / buckets, repeats

    counts = sum(substrings.block_counts(pa.array(t), i, tags, 13, buckets) for t, i in zip(blocks, ids))
    heavy = substrings.heavy_slots(np.arange(len(counts)), counts, counts.sum() / buckets)
    together, share, repeats = most(substrings.NONE_HEAVY)
    dealt, same_share, same = most(heavy)
    assert len(heavy[0]) == 1 and counts.sum() == share * buckets == same_share * buckets
    assert together > 8 * share and dealt < 3 * share
    assert same == repeats == {(d, k) for d in range(1200, 1250) for k in range(17)}

    rows = [(int(k), t) for texts, i in zip(blocks, ids) for k, t in zip(i, texts)]
    for name in ("BLOCK_BYTES", "BUCKET_BYTES", "RESULT_BYTES"):
        monkeypatch.setattr(substrings, name, 20_000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(substrings.remove_repeats(docs)) == brute(rows)


def test_a_block_takes_bounded_memory():
    """Peak of a worker's arrays for a full block, of ordinary words and of words of one letter."""
    rng = random.Random(2)
    for word in (lambda: f"w{rng.randrange(10**5)}", lambda: rng.choice("abcdefgh")):
        texts, size = [], 0
        while size < substrings.BLOCK_BYTES:
            texts.append(" ".join(word() for _ in range(400)))
            size += len(texts[-1])
        ids = np.arange(len(texts))
        tracemalloc.start()
        for _ in substrings.block_entries(pa.array(texts), ids, np.zeros(len(ids), "<u4"), 13, 60, 60):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100 * substrings.BLOCK_BYTES

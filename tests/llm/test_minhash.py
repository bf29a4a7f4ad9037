from collections import Counter

import numpy as np
import pytest

from slotwise.llm import minhash
from slotwise.llm.components import components


def multiset(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return Counter(tuple(low[i:i + 5]) for i in range(len(low) - 4)) if len(low) > 4 else Counter([tuple(low)] if low else [])


def brute(rows, least=0.8):
    """Smallest id of each row's class, from all pairs that share a shingle."""
    texts = sorted({t or "" for _, t in rows})
    sets = [multiset(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for h in holders.values() for n, a in enumerate(h) for b in h[n + 1:]}
    for a, b in pairs:
        both = sum((sets[a] & sets[b]).values())
        if both / (sum(sets[a].values()) + sum(sets[b].values()) - both) >= least:
            parent[find(a)] = find(b)
    label = {t: find(i) for i, t in enumerate(texts)}
    first = {}
    for k, t in rows:
        if k is not None:
            first[label[t or ""]] = min(k, first.get(label[t or ""], k))
    return sorted(((k, first.get(label[t or ""])) for k, t in rows), key=repr)


def got(df):
    return sorted(((r.doc_id, r.class_id) for r in df.collect()), key=repr)


def test_stored_documents_match_all_pairs(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(minhash.classes(docs)) == brute(rows)


def test_chains_and_hot_buckets(spark, monkeypatch):
    """Steps of a chain are alike, its ends are not; blocks are smaller than the bucket."""
    base = [f"w{i}" for i in range(100)]
    rows = [(n, " ".join(base[:100 - n] + [f"x{i}" for i in range(n)])) for n in range(0, 60, 2)]
    rows += [(1000 + n, " ".join([f"y{n}"] + base[1:])) for n in range(40)]
    monkeypatch.setattr(minhash, "BLOCK", 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(minhash.classes(docs)) == brute(rows)


def test_meetings_are_exact_and_report_a_forest():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 50).astype("<u8")
    sets = [np.sort(np.r_[base[:50 - n % 25], rng.integers(0, 2**63, n % 7).astype("<u8")]) for n in range(40)]
    sets += [np.zeros(0, "<u8"), np.sort(rng.integers(0, 2**63, 9000).astype("<u8"))]

    def plain(one, two):
        return [[len(a | b) > 0 and len(a & b) / len(a | b) >= 0.8 for b in map(set, map(bytes_of, two))]
                for a in map(set, map(bytes_of, one))]

    bytes_of = lambda s: s.tolist()
    raw = [s.tobytes() for s in sets]
    assert (minhash.alike(raw[:17], raw[17:]) == plain(sets[:17], sets[17:])).all()
    inside = minhash.alike(raw, None)
    apart = ~np.eye(len(raw), dtype=bool)
    assert (inside[apart] == np.array(plain(sets, sets))[apart]).all()
    ring = np.array([(i, (i + 1) % 6) for i in range(6)] + [(7, 8), (8, 7)])
    assert minhash.forest(ring, 9) == [0, 1, 2, 3, 4, 6]


def test_links_of_a_torn_bucket_are_fewer_than_its_texts(spark):
    """Half of 200 texts that are all alike but for some are compared pairwise; what is reported stays linear."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for n in range(200):
        words = list(base)
        for at in rng.choice(120, int(rng.integers(1, 6)), replace=False):
            words[at] = f"z{n}_{at}"
        rows.append((n, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = minhash.signed(docs).persist()
    texts = docs.select(minhash.text_key(docs.text).alias("node"), "text")
    bucket = nodes.selectExpr("node", "0L as key")
    none = spark.createDataFrame([], "node binary, label binary")
    links = minhash.across_classes(bucket, none, nodes, texts).collect()
    groups = {}
    for _, c in brute(rows):
        groups[c] = groups.get(c, 0) + 1
    assert len(links) == sum(n - 1 for n in groups.values())
    assert got(minhash.classes(docs)) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, "a b c"), (4, "A b  c"), (2, None), (3, ""), (7, "a b c"), (7, "a b c"), (9, "q r s t u v"), (None, "only")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int")
    assert got(minhash.classes(docs)) == brute(rows)
    sizes = {r.doc_id: r.class_size for r in minhash.classes(docs).collect()}
    assert sizes[4] == 4 and sizes[9] == 1
    assert minhash.classes(docs.limit(0)).count() == 0


@pytest.mark.parametrize("share", [0.95, 0.8, 0.5])
def test_darts_agree_as_often_as_sets_are_similar(share):
    rng = np.random.default_rng(1)
    seen = []
    for _ in range(30):
        a = rng.integers(0, 2**63, 300).astype(np.uint64)
        w = rng.random(300) * 4
        out = minhash.darts(np.r_[a, a], np.r_[w, w * share], np.repeat([0, 1], 300), 2)
        seen.append((out[0] == out[1]).mean())
    assert np.mean(seen) == pytest.approx(share, abs=0.03)
    assert (out != 0).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    out = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {out[i] for i in range(41)} == {0} and out[101] == 100 and len(out) == 43


def test_darts_of_few_texts_are_held_at_once(monkeypatch):
    """A megabyte of short texts holds many: their signatures are those of one call, made for few texts at a time."""
    rng = np.random.default_rng(3)
    n = 2 * minhash.DART_TEXTS + 7
    owners = np.sort(rng.integers(0, n, 3 * n))
    hashes, weights = rng.integers(1, 2**63, len(owners)).astype(np.uint64), rng.integers(1, 4, len(owners))
    want = minhash.band_keys(minhash.darts(hashes, weights.astype(float), owners, n))
    real, asked = minhash.darts, []
    monkeypatch.setattr(minhash, "darts", lambda h, w, o, m, *k: asked.append(m) or real(h, w, o, m, *k))
    assert (minhash.text_bands(hashes, weights, owners, n) == want).all()
    assert len(asked) == 3 and max(asked) <= minhash.DART_TEXTS

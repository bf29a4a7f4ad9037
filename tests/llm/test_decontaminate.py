from collections import Counter

import numpy as np

from slotwise.llm import decontaminate


def parts(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return [tuple(low[i:i + 5]) for i in range(len(low) - 4)]


def brute(docs, items, least=0.8):
    """Documents and the smallest id of each item text they hold, from every window of every item's size."""
    texts = {}
    for k, t in items:
        if parts(t):
            texts.setdefault(t, []).append(k)
    out = set()
    for key, text in docs:
        own = parts(text)
        for t, keys in texts.items():
            item = Counter(parts(t))
            if not set(own) & set(item):
                continue
            size = sum(item.values())
            for s in range(max(1, len(own) - size + 1)):
                window = Counter(own[s:s + size])
                both = sum((window & item).values())
                if both / (sum(window.values()) + size - both) >= least:
                    out.add((key, min(keys), len(keys)))
                    break
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.item_id, r.n_items) for r in df.collect()), key=repr)


def test_stored_documents_match_all_windows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    found = got(decontaminate.contaminated(docs, items))
    assert found == brute(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert found
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - len({r[0] for r in found})


ITEM = " ".join(f"i{n}" for n in range(40))


def test_near_and_short_copies(spark):
    words = ITEM.split()
    docs = [
        (1, "a b c d e f g " + ITEM + " h i j k"), (2, " ".join(words[:36])), (3, " ".join(words[:25])),
        (4, "x " * 50 + " ".join(["Q", *words[1:]])), (5, " ".join([*words[:20], "Q", *words[21:]])), (6, ITEM.upper()),
        (None, ITEM), (8, None), (9, ""), (1, "a b c d e f g " + ITEM + " h i j k"), (10, (ITEM + " ") * 3),
    ]
    items = [(7, ITEM), (3, ITEM), (4, "one two three"), (5, None), (6, "")]
    left = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, row int")
    right = spark.createDataFrame([(*i, "s") for i in items], "item_id long, text string, size string")
    assert got(decontaminate.contaminated(left, right)) == brute(docs, items)
    assert decontaminate.contaminated(left.limit(0), right).count() == 0
    assert decontaminate.contaminated(left, right.limit(0)).count() == 0
    assert sorted(r.doc_id for r in decontaminate.clean(left, right).collect()) == [3, 5, 8, 9]


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    rng = np.random.default_rng(3)
    prints = rng.integers(-2**63, 2**63 - 1, 40)
    rows = []
    for n, p in enumerate(prints.tolist()):
        flipped = p
        for bit in rng.choice(64, decontaminate.RADIUS, replace=False).tolist():
            flipped ^= (1 << bit) if bit < 63 else -(1 << 63)
        rows.append((n, p, flipped))
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "n long, a long, b long")
    shared = F.size(F.array_intersect(decontaminate.blocks(F.col("a")), decontaminate.blocks(F.col("b"))))
    assert df.filter(shared == 0).count() == 0

import random
import re
from collections import Counter

import numpy as np
import pytest

from slotwise.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans(divergence.CAPITALS, divergence.SMALL)


def by_force(docs):
    """The whole report from plain counts over every group and kept term."""
    langs = {}
    for text, lang, source in docs:
        words = TERM.findall((text or "").translate(SMALL))
        langs.setdefault(lang or "", []).append((source or "", words))
    out = []
    for lang, rows in langs.items():
        seen = Counter(w for _, words in rows for w in set(words))
        kept = [w for w, n in seen.items() if n >= 10]
        total = Counter(w for _, words in rows for w in words)
        per = {s: Counter() for s, _ in rows}
        for s, words in rows:
            per[s].update(words)

        def ps(counts):
            n = sum(counts[w] for w in kept)
            return {w: 1 + 1_000_000_000 * (counts[w] + 2) // (n + 2 * len(kept)) for w in kept}

        q, p = ps(total), {s: ps(c) for s, c in per.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in per:
            pairs = [(o, sum(f(p[s][w], p[o][w]) for w in kept)) for o in per if o != s]
            terms = [(w, f(p[s][w], q[w])) for w in kept if per[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, 10)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, n) for n, (item, v) in enumerate(found[:most], 1)]
    return sorted(out)


def corpus(n=600, seed=3):
    rng = random.Random(seed)
    words = ["The", "the", "of", "Straße", "ÉTÉ", "été", "x1y", "naïve", "語彙", "q"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)]
    docs = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "fr", None]), rng.choice(["a", "a", "b", "ç", None, "z"])
        some = rng.choices(words, weights=[1 + (hash_ % 7) * (len(source or "") + 1) for hash_ in range(len(words))], k=rng.randint(0, 40))
        docs.append((rng.choice([None, " ".join(some), "-".join(some), " ".join(some)]), lang, source))
    docs += [("Just once, here.", "xx", "only"), ("", "yy", "one"), (None, "yy", "two"), ("word", "yy", None)]
    return docs + docs[:20]


@pytest.mark.parametrize("cells", [divergence.CELLS, 40])
def test_report_by_force(spark, cells, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(divergence.pair_values, "__defaults__", (cells,))
    frame = spark.createDataFrame([(*d, 1, "t") for d in docs], "text string, lang string, source string, n int, term string")
    got = sorted(map(tuple, divergence.audit(frame).collect()))
    assert got == by_force(docs)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband_is_all_that_fewer_than_k_dominate(k):
    rng = np.random.default_rng(k)
    for n in (0, 1, 30, 900):
        count, lang, place = rng.integers(1, 30, n), rng.integers(30, 60, n), rng.permutation(n)
        beaten = np.array([
            ((count >= count[i]) & (lang <= lang[i]) & (place < place[i])).sum() for i in range(n)], dtype=int)
        assert (divergence.undominated(count, lang, place, k) == (beaten < k)).all()


def test_skyband_holds_the_first_ranks_however_it_is_cut(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 50)
    docs = corpus(900, 8)
    frame = spark.createDataFrame(docs, "text string, lang string, source string").repartition(5)
    assert sorted(map(tuple, divergence.audit(frame).collect())) == by_force(docs)


def test_counts_beyond_any_table_stay_exact(spark):
    count, total, terms = 10**13 + 7, 3 * 10**15 + 1, 10**9 + 3
    got = spark.createDataFrame([(count, total, terms)], "c long, t long, v long").select(
        divergence.proportion("c", "t", "v").alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (count + 2) // (total + 2 * terms)


def test_long_text_and_empty_table(spark):
    docs = [("Alpha beta " * 300_000, "en", "a")] + [("alpha gamma", "en", "b")] * 10 + [("beta", "en", "b")] * 9
    frame = spark.createDataFrame(docs, "text string, lang string, source string")
    assert sorted(map(tuple, divergence.audit(frame).collect())) == by_force(docs)
    assert divergence.audit(frame.limit(0)).count() == 0


def test_a_text_is_cut_once_and_every_word_counted_once(spark):
    docs = [("...Ab, aB;\nab--cd", "en", "a"), ("cd cd.", "en", "b"), ("Äb äb 語_語", "en", "b"), ("1 2 3", "en", "b"), ("", "fr", "a"), (None, "fr", "a")]
    rows = divergence.documents_of(spark.createDataFrame(docs, "text string, lang string, source string").repartition(2))
    assert sorted(map(tuple, divergence.kept_terms(rows, 1).collect())) == sorted([
        ("en", "a", "ab", 3, 3), ("en", "a", "cd", 1, 3), ("en", "b", "cd", 2, 3),
        ("en", "b", "Äb", 1, 1), ("en", "b", "äb", 1, 1), ("en", "b", "語", 2, 2)])
    assert sorted(map(tuple, divergence.kept_terms(rows, 2).collect())) == [("en", "a", "cd", 1, 3), ("en", "b", "cd", 2, 3)]
    plan = divergence.kept_terms(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate ") == plan.count("split(") == 1 and "regexp_extract_all" not in plan


def test_terms_beside_every_ascii_character(spark):
    text = "".join(f"{chr(i)}é{chr(i)}{chr(i)}" for i in range(128)) + "\u00a0\u2003x\U00020000"
    rows = divergence.documents_of(spark.createDataFrame([(text, "en", "a")], "text string, lang string, source string"))
    expected = Counter(TERM.findall(text.translate(SMALL)))
    assert {r.term: r.n for r in divergence.kept_terms(rows, 1).collect()} == expected

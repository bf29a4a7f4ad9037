import hashlib
import itertools
import random
import re
import zlib

import pytest

from slotwise.llm import repair

ORDERED = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, lost boolean"


def faults(rows):
    """Faults of rows in order, by the definition."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", text)
        fault = "" if solid else "blank"
        if not fault and (role, text) in seen:
            fault = "duplicate"
        if not fault and solid[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def by_force(rows):
    """All ways to edit a few rows, and the cheapest, least in ASCII."""
    found = faults(rows)
    fillings = [x for n in range(3) for x in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    choices = []
    for (role, text), fault in zip(rows, found):
        ways = [("D", 3, None)]
        if fault not in ("blank", "duplicate"):
            extra = fault == "truncated"
            ways += [("K", extra, (role, text)), *(("R", 2 + extra, (r, text)) for r in ("user", "assistant"))]
        choices.append(ways)
    for ways in itertools.product(*choices):
        for gaps in itertools.product(fillings, repeat=len(rows) + 1):
            cost = sum(w[1] for w in ways) + 2 * sum(map(len, gaps))
            if best and cost > best[0]:
                continue
            audit, out = "", []
            for gap, way in itertools.zip_longest(gaps, ways):
                audit += "I" * len(gap) + (way[0] if way else "")
                out += [(r, "") for r in gap] + ([way[2]] if way and way[2] else [])
            if ORDERED.fullmatch("".join(r[:1] or "?" for r, _ in out)):
                best = min(best or (cost, audit, out), (cost, audit, out), key=lambda b: b[:2])
    return best


def digest(rows):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest()


def test_cheapest_edits_by_force(spark):
    rng = random.Random(5)
    texts = ["One.", "Two!", "three", "  ", "", "Four?\n", "five \t"]
    talks = {n: [(rng.choice(["user", "user", "assistant", "assistant", "system", "tool"]), rng.choice(texts))
                 for _ in range(rng.randint(1, 3))] for n in range(120)}
    rows = [(n, t, *row, False) for n, talk in talks.items() for t, row in enumerate(talk)]
    rng.shuffle(rows)
    got = {r.conv_id: r for r in repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(talks)
    for n, talk in talks.items():
        cost, audit, out = by_force(talk)
        assert (got[n].cost, got[n].audit, got[n].repaired_sha256) == (cost, audit, digest(out)), talk
        assert [got[n].blank, got[n].duplicate, got[n].truncated] == [
            faults(talk).count(f) for f in ("blank", "duplicate", "truncated")]
        assert got[n].illegal == sum(
            a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(talk, talk[1:]))


def test_costs_of_rows_are_those_of_the_definition():
    for initial in "sua?":
        for fault in range(4):
            costs, choices = repair.step_back(repair.AT_END, initial, fault)
            assert min(costs) == 0 and max(costs) <= 4 and 0 <= choices < 256


@pytest.fixture
def small_steps(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    yield
    spark.conf.set(name, before)


def test_long_conversations_cross_batches_and_blocks(spark, small_steps, monkeypatch):
    rng = random.Random(9)
    rows = [(k, t, rng.choice(["user", "assistant"]), rng.choice([f"Text {t}.", "again", "Again."]), t % 11 == 0)
            for k in (1, 2) for t in range(400)]
    rows += [(3, 0, "user", "Long. " * 400_000, False), (3, 1, "assistant", "Yes.", False)]
    docs = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(repair.repair(docs).collect())
    monkeypatch.setattr(repair.backpointers, "__defaults__", (5,))
    assert sorted(repair.repair(docs).collect()) == whole
    assert len(whole[0].audit) >= 363 and whole[2].audit == "KK"
    assert whole[2].repaired_sha256 == digest([("user", "Long. " * 400_000), ("assistant", "Yes.")])


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, None if t == 3 else "assistant", None if t == 5 else "Why. Oh!") for c in range(40) for t in range(8)]
    rows += [(None, 1, "user", "No id."), (7, None, "user", "No turn.")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, lost int")
    got = sorted(map(str, repair.damaged(turns).collect()))
    want = []
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
        row = f"Row(conv_id={c}, turn={t}, role={'user' if fate == 4 else role!r}, text={text!r}, lost={fate == 0})"
        want += [row.replace("role=user", "role='user'")] * (2 if fate == 3 else 1)
    assert got == sorted(want)


def test_odd_rows(spark):
    rows = [
        (1, 4, "user", "All lost.", True),
        (2, None, "user", "First.", False), (2, 9, "assistant", "Last.", False), (2, 2, "", "Odd.", False),
        (None, 1, "user", "No id.", False), (None, 2, "assistant", "None.", False),
        (3, 5, "user", "Tie.", False), (3, 5, "assistant", "Tie.", False), (3, 5, "user", "Tie.", False),
        (4, None, None, None, False), (2**53 + 1, 0, "user", "Big id.", False), (2**53 + 1, 1, "assistant", "So.", False),
    ]
    got = {r.conv_id: r for r in repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got[1][1:] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert (got[2].audit, got[2].cost) == ("KDK", 3)
    assert got[2].gaps == 9 - 2 + 1 - 2 and got[None].audit == "KK" and got[2**53 + 1].audit == "KK"
    # In one turn: assistant, user, user again; the last is a duplicate.
    assert (got[3].gaps, got[3].duplicate, got[3].illegal) == (0, 1, 1)
    assert (got[4].blank, got[4].cost, got[4].audit, got[4].repaired_sha256) == (1, 3, "D", nothing)
    assert repair.repair(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0
    assert repair.repair(repair.damaged(
        spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_no_step_moves_the_rows_of_a_pass_twice(spark):
    """One exchange for the backpointers, one for them and the texts."""
    turns = spark.createDataFrame([(1, 0, "user", "Hi.", False)], SCHEMA)
    plan = repair.repair(turns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2

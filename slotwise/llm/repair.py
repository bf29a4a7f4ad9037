"""Faults of conversations, and the cheapest edits that give them turns in order.

Roles in order are at most one system turn, then user and assistant by turns, or nothing at all. Each row is kept (0),
given the role that is wanted (2) or deleted (3); empty user or assistant rows are inserted (2) anywhere. Blank and
duplicate rows must be deleted; a truncated row that stays adds 1. Of the cheapest ways the one whose initials (Delete,
Insert, Keep, Rerole, in order) are least in ASCII is taken. As the initial of an edit decides the state that follows, the
choice at a row depends on nothing but the state before it and the least costs after it.

So conversations are read twice, both times dealt by conversation and sorted, in one pass whose state is carried across
Arrow batches. The first pass reads rows without their texts from the last to the first and carries the least cost from each
of four states; its backpointers, one byte a row, leave in blocks as rows of their own. The second reads the texts from the
first to the last, each block before its rows, follows the choices, and adds the repaired lines to a digest. A conversation
of any length so needs the memory of one block; only its audit, a byte an edit, is a value of that length.

Rows of one turn are ordered by role and then by the SHA-256 of the text; rows without a turn come first. Null roles and
texts count as one space. A role that starts with none of ``s``, ``u`` and ``a`` (also an empty one) cannot be kept as it is.
Rows without ``conv_id`` form one conversation, whose id is null. A conversation of which no row is left has zeros, an empty
audit and the digest of nothing. Repeated rows are duplicates of the first; extra columns are not read; an empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.llm.common import chosen, small_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
INITIALS = "DIKR"  # in the order of ASCII; a choice is a place in it
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # what the last row was
# The state that a kept row leads to, and the one that an inserted row, or one with a new role, leads to.
AFTER = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
CLEAN, BLANK, DUPLICATE, CUT = range(4)  # faults
SPACE = " \t\n\x0b\x0c\r"
BLOCK = 65536  # backpointers of a block
IN_ORDER = ("su", "ua", "au")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with planted faults, drawn by a checksum of conversation and turn; dropped ones are marked ``lost``."""
    rows = chosen(turns, **{c: c for c in ("conv_id", "turn", "role", "text")})
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"),
        (fate == 0).alias("lost"), F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def step_back(after: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
    """Least costs from each state before a row, less the least of them, and the choices in one byte."""
    stays = TRUNCATED if fault == CUT else 0
    options: list[list[tuple[int, int]]] = []
    for state in range(4):
        found = [(DELETE + after[state], INITIALS.index("D"))]
        if fault not in (BLANK, DUPLICATE):
            if (state, initial) in AFTER:
                found.append((KEEP + stays + after[AFTER[state, initial]], INITIALS.index("K")))
            found.append((REROLE + stays + after[WANTED[state]], INITIALS.index("R")))
        options.append(found)
    costs = [min(found)[0] for found in options]
    for _ in range(2):  # two insertions lead back to the same state
        costs = [min(c, INSERT + costs[WANTED[s]]) for s, c in enumerate(costs)]
    choices = 0
    for state, found in enumerate(options):
        found.append((INSERT + costs[WANTED[state]], INITIALS.index("I")))
        choices |= min(found)[1] << 2 * state
    least = min(costs)
    return tuple(c - least for c in costs), choices


#: Least costs at the end: an answer is missing after a user, a user and an answer after a system turn.
AT_END = (0, 2 * INSERT, INSERT, 0)


def initial_of(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("?")


def backpointers(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of choices and faults of rows in order, each under the place of its first row.

    The checksum of a text stands for it: two rows are duplicates if role and SHA-256 are equal. A block ends only
    between different places, so that it comes before its rows wherever these are sorted by place.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    light = rows.filter(~F.col("lost")).select(
        "key", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        initial_of(F.col("role")).alias("initial"), (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut"),
    ).repartition("key")
    # Dealt by conversation already: neither the window nor the order moves rows again.
    earlier = W.partitionBy("key", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("nth") > 1, DUPLICATE).when(F.col("cut"), CUT).otherwise(CLEAN)
    light = light.withColumn("nth", F.row_number().over(earlier)).withColumn("fault", fault)
    ordered = light.sortWithinPartitions(
        "key", F.desc_nulls_last("turn"), F.desc("role"), F.desc("digest"), F.desc("nth"))
    # Numbers that may be null go as text, since pandas would make them inexact.
    ordered = ordered.select("key", F.col("turn").cast("string").alias("turn"), "role", "digest", "initial", "fault")
    names = ["key", "turn", "role", "digest", "choices", "faults"]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple, tuple] = {}  # least costs differ by a few units, so that there are few of them
        begun, key, place = False, None, None
        costs = AT_END
        choices, faults = bytearray(), bytearray()
        found: list[tuple] = []

        def close() -> None:
            if choices:
                found.append((key, *place, bytes(reversed(choices)), bytes(reversed(faults))))
                choices.clear()
                faults.clear()

        for batch in batches:
            for k, turn, role, digest, initial, fault in batch.itertuples(index=False, name=None):
                here = (turn, role, digest)
                if not begun or k != key:
                    close()
                    begun, key, costs = True, k, AT_END
                elif len(choices) >= block and here != place:
                    close()
                place = here
                if (costs, initial, fault) not in known:
                    known[costs, initial, fault] = step_back(costs, initial, fault)
                costs, choice = known[costs, initial, fault]
                choices.append(choice)
                faults.append(int(fault))
            if found:
                yield pd.DataFrame(found, columns=names)
                found = []
        close()
        if found:
            yield pd.DataFrame(found, columns=names)

    return ordered.mapInPandas(
        run, "key string, turn string, role string, digest string, choices binary, faults binary")


class Conversation:
    """What is known of a conversation whose rows come in order."""

    def __init__(self, key: str | None) -> None:
        self.key = key
        self.counts = [0, 0, 0, 0]
        self.illegal = self.cost = self.distinct = 0
        self.first_turn = self.last_turn = self.initial = None
        self.state, self.audit, self.lines, self.digest = NOTHING, [], 0, hashlib.sha256()
        self.choices, self.faults, self.at = b"", b"", 0

    def line(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "replace"))
        self.lines += 1

    def insert(self) -> None:
        self.state = WANTED[self.state]
        self.line(NAMES[self.state], "")
        self.audit.append("I")
        self.cost += INSERT

    def block(self, choices: bytes, faults: bytes) -> None:
        self.choices, self.faults, self.at = choices, faults, 0

    def row(self, turn: int | None, role: str, text: str) -> None:
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in IN_ORDER:
            self.illegal += 1
        self.initial = initial
        if turn is not None:
            if turn != self.last_turn:
                self.distinct += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        choices, fault = self.choices[self.at], self.faults[self.at]
        self.at += 1
        self.counts[fault] += 1
        while (choice := INITIALS[choices >> 2 * self.state & 3]) == "I":
            self.insert()
        self.audit.append(choice)
        if choice == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED if fault == CUT else 0
        if choice == "K":
            self.state = AFTER[self.state, initial]
            self.cost += KEEP
        else:
            self.state = WANTED[self.state]
            self.cost += REROLE
            role = NAMES[self.state]
        self.line(role, text)

    def result(self) -> tuple:
        while self.state in (SYSTEM, USER):
            self.insert()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct
        return (self.key, gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT], self.illegal, self.cost,
                "".join(self.audit), self.digest.hexdigest())


FIELDS = {"key": pa.string(), "gaps": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(),
          "illegal": pa.int64(), "cost": pa.int64(), "audit": pa.string(), "repaired_sha256": pa.string()}


def repair(rows: DataFrame) -> DataFrame:
    """A row per conversation: its faults, the cheapest edits, their cost, and the digest of the repaired turns.

    ``rows`` has ``conv_id``, ``turn`` (a whole number), ``role``, ``text`` and ``lost``; lost rows only tell that
    their conversation exists.
    """
    small_batches(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType
    keyed = rows.select(
        F.col("conv_id").cast("string").alias("key"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.when(~F.col("lost"), F.coalesce("text", F.lit(" "))).alias("text"), "lost")
    blocks = backpointers(keyed).select(
        "key", F.col("turn").cast("long").alias("turn"), "role", "digest", F.lit(None).cast("string").alias("text"),
        F.lit(False).alias("lost"), "choices", "faults")
    full = keyed.select(
        "key", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text", "lost",
        F.lit(None).cast("binary").alias("choices"), F.lit(None).cast("binary").alias("faults"))
    both = blocks.unionByName(full).repartition("key").sortWithinPartitions(
        "key", F.asc_nulls_first("turn"), "role", "digest", F.col("choices").isNull())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        names = ("key", "turn", "role", "text", "lost", "choices", "faults")
        for batch in batches:
            done = []
            for key, turn, role, text, lost, choices, faults in zip(*(batch.column(n).to_pylist() for n in names)):
                if now is None or key != now.key:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(key)
                if choices is not None:
                    now.block(choices, faults)
                elif not lost:
                    now.row(turn, role, text)
            if done:
                yield arrow(done)
        if now is not None:
            yield arrow([now.result()])

    schema = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in FIELDS.items())
    out = both.mapInArrow(run, schema)
    return out.select(F.col("key").cast(kind).alias("conv_id"), *[n for n in FIELDS if n != "key"])


def arrow(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), FIELDS.values())], list(FIELDS))


def _least(*options: str) -> str:
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o.c IS NOT NULL))"


def _way(cost: str, edit: str, line: str, then: str) -> str:
    return f"{{'c': {cost} + {then}.c, 'a': '{edit}' || {then}.a, 'l': {line} || {then}.l}}"


def _repair_sql() -> str:
    """Least costs, audits and lines by recursion from the last row of each conversation to its first."""
    delete = {s: _way("3", "D", "[]::VARCHAR[]", f"w{s}") for s in range(4)}
    keep = lambda i, t: _way(f"CASE WHEN NOT must AND initial = '{i}' THEN cut END", "K", "[role || ':' || text]", f"w{t}")  # noqa: E731, E501
    rerole = lambda r, t: _way("CASE WHEN NOT must THEN 2 + cut END", "R", f"['{r}:' || text]", f"w{t}")
    p = [
        _least(delete[0], keep("s", 1), keep("u", 2), rerole("user", 2)),
        _least(delete[1], keep("u", 2), rerole("user", 2)),
        _least(delete[2], keep("a", 3), rerole("assistant", 3)),
        _least(delete[3], keep("u", 2), rerole("user", 2)),
    ]
    user, both, answer = "['user:']", "['user:', 'assistant:']", "['assistant:']"
    v = [
        _least("p0", _way("2", "I", user, "p2"), _way("4", "II", both, "p3")),
        _least("p1", _way("2", "I", user, "p2"), _way("4", "II", both, "p3")),
        _least("p2", _way("2", "I", answer, "p3")),
        _least("p3", _way("2", "I", user, "p2")),
    ]
    end = "{{'c': {}::BIGINT, 'a': '{}', 'l': {}::VARCHAR[]}}".format
    return f"""
WITH RECURSIVE d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda s: unicode(s)::BIGINT) AS b
  FROM conversations),
f AS (SELECT * EXCLUDE (b), xor(list_reduce([4294967295] || b, lambda c, x: list_reduce([xor(c, x)] || range(8),
  lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % 20 AS fate FROM d),
g AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
  CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy, fate FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM g WHERE fate <> 0),
t AS (SELECT *, left(role, 1) AS initial, trimmed = '' AS blank, trimmed <> '' AND nth > 1 AS dup,
  trimmed <> '' AND nth = 1 AND right(trimmed, 1) NOT IN ('.', '!', '?') AS short FROM r),
u AS (SELECT *, blank OR dup AS must, short::INT AS cut, lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS prior FROM t),
counts AS (SELECT conv_id, count(*) AS m, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (short) AS truncated,
  count(*) FILTER (prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM u GROUP BY conv_id),
dp AS (
  SELECT conv_id, m + 1 AS n, {end(0, '', '[]')} AS w0, {end(4, 'II', both)} AS w1, {end(2, 'I', answer)} AS w2, {end(0, '', '[]')} AS w3 FROM counts
  UNION ALL
  SELECT conv_id, n, {', '.join(f'{x} AS w{s}' for s, x in enumerate(v))} FROM (
    SELECT u.conv_id, u.n, {', '.join(f'{x} AS p{s}' for s, x in enumerate(p))}
    FROM dp JOIN u ON u.conv_id IS NOT DISTINCT FROM dp.conv_id AND u.n = dp.n - 1))
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
  coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(w0.c, 0)::BIGINT AS cost,
  coalesce(w0.a, '') AS audit, sha256(coalesce(array_to_string(w0.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN (SELECT * FROM dp WHERE n = 1) e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


REPAIR_SQL = _repair_sql()

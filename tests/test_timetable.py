"""The timetable rule: hand-computed cases, a loop version on random groups, and the plan."""

import random
from datetime import date, datetime, time, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from slotwise.operators import profiles, timetable
from slotwise.operators.prepare import with_calendar
from slotwise.sources.sinks import attach_bucketed

KEY = ("k",)


def minutes(*hours):
    """Minutes of the day of times as written."""
    read = [time.fromisoformat(h) for h in hours]
    return [60 * t.hour + t.minute for t in read]


def reference(spark, times, gap=120, min_obs=2):
    df = spark.createDataFrame([("a", m) for m in times], "k string, min_dia int")
    got = timetable.slot_reference(df, KEY, gap=gap, min_obs=min_obs)
    found = {r.min_dia: r.hora_referencia_min for r in got.collect()}
    return [found[m] for m in times]


# Published cases of the rule with their results.
@pytest.mark.parametrize("times, expected", [
    (minutes("11:11", "11:32", "11:05", "11:18", "11:07"), [671] * 5),
    (minutes("07:15", "07:08", "07:11", "19:36", "19:26", "19:34"), [431] * 3 + [1174] * 3),
    (minutes("23:50", "23:58", "00:05", "00:10", "23:45"), [1438] * 5),
    (minutes("21:00", "21:05", "20:55", "21:10", "03:00"), [1262.5] * 5),
    (minutes("09:00"), [540]),
    ([5, 10, 700, 705, 1430], [5, 5, 702.5, 702.5, 5]),
])
def test_known_cases(spark, times, expected):
    assert reference(spark, times) == expected


def wrap(x):
    return (x + 720) % 1440 - 720


def by_loop(times, gap=120, min_obs=2):
    """The rule as a plain walk around the clock."""
    order = sorted(times)
    n = len(order)
    ends = [i for i in range(n) if (order[i + 1] if i + 1 < n else order[0] + 1440) - order[i] > gap]
    slots = []
    if not ends or n == 1:
        slots.append(order)
    else:
        at = (ends[-1] + 1) % n
        slot = []
        for step in range(n):
            i = (at + step) % n
            slot.append(order[i])
            if i in ends:
                slots.append(slot)
                slot = []
    described = [((s[0] + median([wrap(m - s[0]) for m in s])) % 1440, len(s)) for s in slots]
    usual = [c for c, size in described if size >= min_obs]
    if not usual:
        usual = [max(described, key=lambda d: d[1])[0]]
    return {m: min(usual, key=lambda c: abs(wrap(m - c))) for m in times}


def test_random_groups_match_a_loop(spark):
    rng = random.Random(7)
    groups = {}
    for g in range(400):
        bases = [rng.randrange(1440) for _ in range(rng.choice([1, 1, 2, 3]))]
        size = rng.choice([1, 2, 3, 5, 8, 30])
        spread = rng.choice([5, 40, 200, 1440])
        groups[g] = [(rng.choice(bases) + rng.randrange(spread)) % 1440 for _ in range(size)]
    rows = [(g, m) for g, ms in groups.items() for m in ms]
    df = spark.createDataFrame(rows, "k int, min_dia int")
    got = {(r.k, r.min_dia): r.hora_referencia_min for r in timetable.slot_reference(df, KEY).collect()}
    for g, ms in groups.items():
        for m, ref in by_loop(ms).items():
            assert got[g, m] == ref, (g, ms, m)


COLUMNS = "dt_operacion timestamp, aerolinea_dgac string, numero_vuelo string, tipo_operacion string, es_internacional boolean"


def operations(spark, *flights):
    """One row per given minute of a flight, on days of their own; a flight is (number, minutes of day)."""
    rows = [
        (datetime(2022, 9, 5) + timedelta(weeks=n, minutes=m), "QX", number, "D", True)
        for number, times in flights for n, m in enumerate(times)
    ]
    return spark.createDataFrame(rows, COLUMNS)


# Three usual departures around 14:30, then one that deviates.
USUAL = [870, 866, 874]


@pytest.mark.parametrize("last, label", [(870 + 40, 1), (870 + 12, 0), (870 - 55, 0)])
def test_only_what_is_clearly_later_is_late(spark, last, label):
    out = timetable.delay_target(operations(spark, ("q1", [*USUAL, last])))
    by_minute = {r.dt_operacion.hour * 60 + r.dt_operacion.minute: r for r in out.collect()}
    assert by_minute[last].retraso == label
    assert sum(r.retraso for r in by_minute.values()) == label
    assert all(isinstance(r.fecha_cruce, date) and not isinstance(r.fecha_cruce, datetime) for r in by_minute.values())


def test_flights_need_support_and_a_number(spark):
    out = timetable.delay_target(operations(spark, ("q1", USUAL), ("rare", [300, 990]), (None, USUAL)))
    assert {r.numero_vuelo for r in out.collect()} == {"q1"}


def test_profile_lists_only_supported_slots(spark):
    out = timetable.delay_target(operations(spark, ("q1", [*USUAL, 870]), ("q2", [100, 104, 97])))
    got = {r.numero_vuelo: r for r in profiles.slot_profile(out, 4).collect()}
    assert set(got) == {"q1"} and got["q1"].n_operaciones == 4
    # Deviations 0, -4, 4, 0: quartiles -1 and 1.
    assert got["q1"].variabilidad_min == 2.0


def test_large_lookup_is_joined_without_a_broadcast(spark, monkeypatch):
    from slotwise.operators import sizing

    small = timetable.delay_target(operations(spark, ("q1", [*USUAL, 910])))
    want = sorted(map(str, small.collect()))
    monkeypatch.setattr(sizing.broadcast_if_small, "__defaults__", (1,))
    large = timetable.delay_target(operations(spark, ("q1", [*USUAL, 910])))
    assert sorted(map(str, large.collect())) == want


def test_one_shuffle_by_key_after_the_counts(spark):
    df = with_calendar(operations(spark, ("q1", USUAL)))
    plan = timetable.slot_reference(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_stored_counts_give_the_timetable_without_a_shuffle(spark, tmp_path):
    rng = random.Random(11)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([300, 310, 700, 1435, 5, None]), i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, min_dia int, month int")
    path = str(tmp_path / "counts")
    args = {"keys": KEY, "buckets": 4}
    timetable.store_minute_counts(df.filter("month = 0"), "counts_in_parts", path, **args)
    # The second part holds keys and minutes of the first one.
    table = timetable.store_minute_counts(df.filter("month = 1"), "counts_in_parts", path, append=True, **args)
    want = sorted(map(tuple, timetable.slot_reference(df, KEY).collect()))
    found = timetable.stored_slot_reference(table, KEY)
    assert sorted(map(tuple, found.collect())) == want
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    # A catalog that knows nothing of the table takes it up from its files.
    again = attach_bucketed(spark, "counts_again", path, KEY, 4, ["m"])
    plan = timetable.stored_slot_reference(again, KEY)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, plan.collect())) == want
    empty = timetable.store_minute_counts(df.limit(0), "counts_of_none", str(tmp_path / "none"), **args)
    assert timetable.stored_slot_reference(empty, KEY).count() == 0
    for name in ("counts_in_parts", "counts_again", "counts_of_none"):
        spark.sql(f"DROP TABLE {name}")

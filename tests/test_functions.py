"""Column expressions, on batches and on a stream."""

import math

from pyspark.sql import functions as F

from slotwise.functions import binning as B
from slotwise.functions import cleaning as C
from slotwise.functions import clock, wind


def _one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_wrap_keeps_small_differences(spark):
    df = spark.createDataFrame([(0.0,), (15.0,), (-20.0,)], "m double")
    assert [r[0] for r in df.select(clock.wrap_minutes("m")).collect()] == [0.0, 15.0, -20.0]


def test_wrap_crosses_midnight_both_ways(spark):
    assert _one(spark, clock.wrap_minutes(F.lit(10 - 1430))) == 20
    assert _one(spark, clock.wrap_minutes(F.lit(1430 - 10))) == -20
    assert _one(spark, clock.wrap_minutes(F.lit(-2140))) == -700
    assert _one(spark, clock.wrap_minutes(F.lit(720))) == -720


def test_weekday_starts_on_monday(spark):
    day = F.lit("2024-03-01").cast("date")  # a Friday
    assert _one(spark, clock.weekday_from_monday(day)) == 4


def test_zone_conversion_decides_the_month(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-03-01 01:30:00' AS ts")  # session zone is UTC
    row = df.select(clock.month_key(clock.in_zone("ts", "America/Santiago")).alias("m")).first()
    assert row["m"] == 202402


def test_missing_is_null_only(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None)], "x double, t string")
    assert [r.x for r in C.nan_to_null(df).collect()] == [None, 1.0]
    assert _one(spark, C.exceeds(F.lit(None).cast("double"), 15)) == 0
    assert _one(spark, C.to_number(F.lit("NaN"))) is None
    assert _one(spark, C.to_number(F.lit("n/a"))) is None


def test_clip_leaves_null(spark):
    assert _one(spark, C.clip(F.lit(None).cast("double"), 0.0, 1.0)) is None
    assert _one(spark, C.clip(F.lit(9.0), 0.0, 1.0)) == 1.0


def test_bands_are_closed_on_the_right(spark):
    values = [-0.2, -0.1, 0.0, 0.5, 1.0, 1.0001, 15.0, 1000.0, 1000.1, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(B.band("v", B.RAIN_EDGES, B.RAIN_LABELS)).collect()]
    assert got == [None, None, "Sin lluvia", "0-1 mm", "0-1 mm", "1-5 mm", "5-15 mm", "> 15 mm", None, None]


def test_histogram_maximum_is_in_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    got = [r[0] for r in df.select(B.equal_width_bin("v", F.lit(0.0), F.lit(10.0), 4)).collect()]
    assert got == [1, 3, 4]


def test_cross_wind_follows_the_runway(spark):
    rows = [(20.0, 170.0), (20.0, 260.0), (20.0, 350.0), (20.0, None)]
    df = spark.createDataFrame(rows, "wspd double, wdir double")
    got = df.select(wind.cross_wind("wspd", "wdir").alias("x"), wind.head_wind("wspd", "wdir").alias("h")).collect()
    assert [round(r.x, 6) for r in got] == [0.0, 20.0, 0.0, 10.0]
    assert [round(r.h, 6) for r in got] == [20.0, 0.0, -20.0, 0.0]
    assert math.isclose(got[3].h, 0.0)


def test_pseudonym_hides_and_is_stable(spark):
    df = spark.createDataFrame([("CC-ABC",), ("CC-ABC",), (None,)], "m string")
    a, b, c = [r[0] for r in df.select(C.pseudonym("m", "s")).collect()]
    assert a == b and len(a) == 64 and "ABC" not in a and c is None


def test_row_expressions_run_on_a_stream(spark, sf):
    """No state is needed, so the same expressions serve a streaming table."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    out = stream.select(
        "event_id", clock.minute_of_day("ts").alias("m"), C.exceeds("value", 30).alias("alerta"))
    q = out.writeStream.format("memory").queryName("rowwise").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("rowwise").count() == spark.read.parquet(f"{sf}/events.parquet").count()

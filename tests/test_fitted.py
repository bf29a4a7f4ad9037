"""What is learnt once: codes and numbers of one table, applied to others and after a reload; tables that are replaced."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from slotwise.operators import fitted
from slotwise.session import scratch_path
from slotwise.sources import sinks


@pytest.fixture(scope="module")
def codes(spark):
    learn = spark.createDataFrame([("b", 1.0), ("a", None), (None, 3.0), ("c", 8.0), ("b", 2.0)], "who string, x double")
    return fitted.fit_codes(learn, {"who": "code"})


def test_codes_do_not_change_with_the_table(spark, codes):
    path = scratch_path(spark, "codes")
    sinks.save_model(codes, path)
    later = spark.createDataFrame([("c",), ("zz",), (None,), ("",), ("c",)], "who string")
    got = [r.code for r in sinks.load_pipeline(path).transform(later).orderBy(F.asc_nulls_first("who")).collect()]
    assert got == [-1, 3, 2, 2, 3]


def test_codes_of_missing_values_as_text(spark):
    learn = spark.createDataFrame([("z",), (None,), ("a",)], "who string")
    model = fitted.CategoryCodes(column="who", output="code", missing="nan").fit(learn)
    assert {r.who: r.code for r in model.transform(learn).collect()} == {"a": 0, None: 1, "z": 2}


def test_nothing_to_learn_codes_from(spark):
    model = fitted.fit_codes(spark.createDataFrame([], "who string"), {"who": "code"})
    got = model.transform(spark.createDataFrame([("a",), (None,)], "who string"))
    assert {r.who: r.code for r in got.collect()} == {"a": 0, None: -1}


def test_numbers_are_filled_and_scaled_by_what_was_learnt(spark):
    learn = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0), (8.0, None)], "x double, k double")
    model = Pipeline(stages=[fitted.FilledNumbers(columns=["x", "k"])]).fit(learn)
    path = scratch_path(spark, "numbers")
    sinks.save_model(model, path)
    later = spark.createDataFrame([(None, 7.0), (10.0, None)], "x double, k double")
    a, b = sinks.load_pipeline(path).transform(later).orderBy("x").collect()
    mean, sd = 15 / 4, (sum((v - 15 / 4) ** 2 for v in (1, 3, 3, 8)) / 4) ** 0.5
    assert (a.x, a.k, a.z_k) == (3.0, 7.0, 2.0) and a.z_x == pytest.approx((3 - mean) / sd)
    assert b.k == 5.0 and b.z_x == pytest.approx((10 - mean) / sd)


def test_a_failed_write_leaves_the_old_table(spark):
    path = scratch_path(spark, "kept")
    sinks.save_table(spark.range(5), path)
    broken = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.save_table(broken, path)
    assert spark.read.parquet(path).count() == 5


def test_a_table_is_replaced_by_one_computed_from_it(spark):
    path = scratch_path(spark, "again")
    first = sinks.save_table(spark.range(6).withColumn("p", F.col("id") % 2), path, ["p"])
    second = sinks.save_table(first.filter("id > 2"), path, ["p"])
    assert sorted(r.id for r in second.collect()) == [3, 4, 5]
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    left = [f.getPath().getName() for f in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(path).getParent())]
    assert not [n for n in left if n.startswith(path.rsplit("/", 1)[1] + "__")]

"""Expectations, change feed and profiling."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shoplake.operators import changes, profile, quality

RULES = {"positive": "v > 0", "named": "n IS NOT NULL"}


@pytest.fixture
def data(spark):
    return spark.createDataFrame([(1, "a"), (-1, "b"), (None, "c"), (4, None)], "v int, n string")


def test_warn_keeps_rows_and_counts_unknown_as_broken(data):
    kept, metrics = quality.expect(data, RULES)
    assert rows(kept) == rows(data)
    assert {r.expectation: (r.total_rows, r.passed_rows, r.failed_rows) for r in metrics.collect()} == {
        "positive": (4, 2, 2),
        "named": (4, 3, 1),
    }


def test_drop(data):
    kept, metrics = quality.expect_or_drop(data, {"positive": F.col("v") > 0, "named": F.col("n").isNotNull()})
    assert [tuple(r) for r in kept.collect()] == [(1, "a")]
    assert metrics.count() == 2


def test_fail(data):
    with pytest.raises(quality.ExpectationError, match="positive: 2 rows"):
        quality.expect_or_fail(data, RULES)
    assert quality.expect_or_fail(data.filter("v > 0 AND n IS NOT NULL"), RULES).count() == 1


def test_enforce(data):
    good = data.filter("v > 0 AND n IS NOT NULL")
    assert rows(quality.enforce(good, RULES)) == rows(good)
    with pytest.raises(PySparkException, match="expectation (positive|named) failed"):
        quality.enforce(data, RULES).collect()
    with pytest.raises(PySparkException, match="expectation (positive|named) failed"):
        quality.enforce(data, RULES).select("n").count()


def test_observe(data):
    watched, seen = quality.observe(data, RULES)
    assert watched.count() == 4
    assert seen.get == {"_rows": 4, "positive": 2, "named": 1}


def test_change_feed(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1), (None, "n", 1)], "k int, a string, b int")
    new = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "d", 1), (None, "n", 2)], "k int, a string, b int")
    found = {(r.k, r.change_type, r.a, r.b) for r in changes.change_feed(old, new, ["k"]).collect()}
    assert found == {(2, "update", "b", None), (3, "delete", "c", 1), (4, "insert", "d", 1), (None, "update", "n", 2)}


def test_change_feed_refuses_repeated_keys(spark):
    one = spark.createDataFrame([(1, "a")], "k int, a string")
    with pytest.raises(PySparkException, match="key repeats"):
        changes.change_feed(one.union(one), one, ["k"]).collect()


def test_sparse_columns(spark):
    df = spark.range(100).select(
        "id",
        F.when(F.col("id") < 10, 1).alias("tenth"),
        F.when(F.col("id") < 11, 1).alias("more"),
        F.when(F.col("id") < 5, 1).alias("five"),
        F.when(F.col("id") < 6, 1).alias("six"),
        F.lit(None).cast("int").alias("never"),
    )
    assert profile.keep_filled(df, 0.1).columns == ["id", "more"]
    assert profile.drop_mostly_null(df, 0.95).columns == ["id", "tenth", "more", "six"]
    assert profile.keep_filled(df.limit(0), 0.1).columns == df.columns


def test_odd_column_names(spark):
    df = spark.createDataFrame([(None, "-")], "`a.b` string, `c d` string")
    assert {r.column_name: r.null_rows for r in profile.null_counts(df).collect()} == {"a.b": 1, "c d": 0}
    assert {r.column_name: r.sentinel_rows for r in profile.sentinel_counts(df).collect()} == {"a.b": 0, "c d": 1}


def test_amount_repair_uses_repaired_values(spark):
    df = spark.createDataFrame(
        [(2, 10.0, 5.0, 99.0, 5.0, 1.0, 1.0), (1, 5.0, 5.0, 9.0, 1.0, 1.0, 1.0)],
        "quantity int, unit_price_usd double, discount_amount_usd double, total_price_usd double, cost_usd double, profit_usd double, profit_margin_percent double",
    )
    fixed = profile.amount_repair(df).orderBy("quantity").collect()
    assert [(r.total_price_usd, r.profit_usd, r.profit_margin_percent) for r in fixed][1] == (15.0, 10.0, pytest.approx(66.6667, abs=1e-3))
    assert (fixed[0].total_price_usd, fixed[0].profit_margin_percent) == (0.0, None)


def test_existence_and_dates(spark):
    df = spark.createDataFrame([(None, dt.date(2024, 1, 2))], "k string, d date")
    assert not profile.any_filled(df, "k") and profile.any_filled(df, "d")
    assert profile.first_filled(df, "k").first().key_exists is False
    assert profile.future_dates(df, "d", F.lit(dt.date(2024, 1, 1))).count() == 1
    assert profile.future_dates(df, "d", F.lit(dt.date(2024, 1, 2))).count() == 0


def test_profiles_read_their_table_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    for made in (profile.null_counts(df), profile.column_summary(df), profile.domain_values(df, ["o_orderstatus", "o_orderpriority"])):
        assert made._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1

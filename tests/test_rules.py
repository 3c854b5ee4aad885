"""Rules at their limits and for NULL."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shoplake.functions import rules as r
from shoplake.functions.shape import conform
from shoplake.plans import aggregates, dimensions, facts, silver


def values(spark, column, inputs, dtype):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {dtype}")
    return [row[0] for row in df.orderBy("i").select(column(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "rule, dtype, pairs",
    [
        (r.tidy, "string", [(" Ab ", "ab"), ("", ""), ("  ", ""), (None, None)]),
        (r.tidy_or_null, "string", [(" Ab ", "ab"), ("", None), ("  ", None), (None, None)]),
        (r.proper_case, "string", [(" jOHN smith ", "John Smith"), (None, None)]),
        (r.gender_bucket, "string", [("male", "male"), ("female", "female"), ("unknown", "other"), ("", "other"), (None, "unknown")]),
        (r.yes_flag, "string", [(" YES ", 1), ("no", 0), ("", 0), (None, 0)]),
        (lambda c: r.at_least(c, 0), "double", [(-0.1, None), (0.0, 0.0), (None, None)]),
        (lambda c: r.above(c, 0), "int", [(0, None), (1, 1), (None, None)]),
        (lambda c: r.not_under(c, 0), "int", [(-3, 0), (0, 0), (4, 4), (None, None)]),
        (lambda c: r.within(c, 1, 5), "int", [(0, None), (1, 1), (5, 5), (6, None), (None, None)]),
        (lambda c: r.null_or_within(c, 10, 100), "int", [(9, False), (10, True), (100, True), (101, False), (None, True)]),
        (lambda c: r.one_of(c, ("a", "b"), "z"), "string", [("a", "a"), ("c", "z"), (None, "z")]),
        (
            lambda c: r.band_below(c, dimensions.AGE_GROUPS, "65+"),
            "int",
            [(10, "18-24"), (24, "18-24"), (25, "25-34"), (35, "35-44"), (45, "45-54"), (64, "55-64"), (65, "65+"), (None, "65+")],
        ),
        (
            lambda c: r.band_from(c, dimensions.LOYALTY_TIERS, "basic"),
            "double",
            [(80.0, "platinum"), (79.9, "gold"), (60.0, "gold"), (40.0, "silver"), (20.0, "bronze"), (19.9, "basic"), (None, "basic")],
        ),
        (
            lambda c: r.band_below(c, dimensions.PRICE_TIERS, "luxury"),
            "double",
            [(19.99, "budget"), (20.0, "economy"), (50.0, "standard"), (100.0, "premium"), (200.0, "luxury"), (None, "luxury")],
        ),
        (
            lambda c: r.band_from(c, dimensions.PRODUCT_RATINGS, "not_rated", known="below_average"),
            "double",
            [(4.5, "excellent"), (4.0, "very_good"), (3.5, "good"), (3.0, "average"), (2.9, "below_average"), (None, "not_rated")],
        ),
        (
            lambda c: r.band_from(c, facts.FRAUD_LEVELS, "unknown", known="low"),
            "double",
            [(70.0, "high"), (69.0, "medium"), (40.0, "medium"), (39.0, "low"), (None, "unknown")],
        ),
        (
            lambda c: r.band_up_to(c, facts.DELIVERY_SPEEDS, "slow"),
            "int",
            [(2, "express"), (3, "fast"), (5, "fast"), (10, "standard"), (11, "slow"), (None, "slow")],
        ),
        (
            lambda c: r.band_up_to(c, aggregates.RECENCY, "churned"),
            "int",
            [(30, "active"), (31, "at_risk"), (90, "at_risk"), (180, "dormant"), (181, "churned"), (None, "churned")],
        ),
        (
            lambda c: r.band_equal(c, facts.REVIEW_RATINGS, "not_rated"),
            "int",
            [(5, "excellent"), (4, "good"), (3, "average"), (2, "poor"), (1, "very_poor"), (None, "not_rated")],
        ),
    ],
)
def test_rule(spark, rule, dtype, pairs):
    assert values(spark, rule, [i for i, _ in pairs], dtype) == [o for _, o in pairs]


def test_zero_division_is_null(spark):
    assert values(spark, lambda c: r.percent(F.lit(1), c), [0, 4, None], "int") == [None, 25.0, None]


def test_surrogate_key_without_date(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 5)), ("B", None)], "id string, d date")
    keys = [row[0] for row in df.orderBy("id").select(r.composite_key(F.col("id"), F.col("d"))).collect()]
    assert keys == ["A_2024-01-05", "B"]


def test_malformed_values_become_null(spark):
    df = spark.createDataFrame([("P1", "abc", "12.0", "x"), ("P2", "3.5", "7", "4.5")], "product_id string, unit_price_usd string, stock_quantity string, product_rating_avg string")
    shaped = conform(df, "products").orderBy("product_id").collect()
    assert [(s.unit_price_usd, s.stock_quantity, s.product_rating_avg) for s in shaped] == [(None, 12, None), (Decimal("3.5000"), 7, 4.5)]
    assert shaped[0].brand is None and shaped[0]._ingestion_timestamp is None


def test_stock_status(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([0, 9, 10, 49, 50, None])], "i int, stock_quantity int")
    shaped = dimensions.dim_products(conform(df.withColumn("product_id", F.col("i").cast("string")), "products")).orderBy("product_id")
    assert [row.stock_status for row in shaped.collect()] == ["out_of_stock", "low_stock", "in_stock", "in_stock", "high_stock", "high_stock"]


def test_date_dimension_keeps_a_null_row(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31),), (None,), (dt.date(2023, 12, 31),)], "order_date date")
    null, sunday = sorted(dimensions.dim_date(df).collect(), key=lambda row: str(row.date), reverse=True)
    assert null.date is None and null.is_weekend == 0 and null.day_type == "weekday" and null.quarter_name is None
    assert (sunday.date_key, sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (20231231, 1, "Sunday", 1)
    assert (sunday.week_of_year, sunday.year_quarter, sunday.month_end_date) == (52, "2023-Q4", dt.date(2023, 12, 31))


def test_silver_accepts_missing_and_reordered_columns(spark):
    df = spark.createDataFrame([(" Completed", "O1", "yes ", "C1")], "order_status string, order_id string, coupon_used string, coupon_code string")
    row = silver.orders(df).first()
    assert (row.order_key, row.order_status, row.coupon_used, row.coupon_code, row.country) == ("O1", "completed", 1, "C1", None)


def test_repeated_order_id_fans_out(spark):
    """Orders are not deduplicated: both rows of a repeated id get the order's totals."""
    orders = silver.orders(spark.createDataFrame([("O1", dt.date(2024, 1, 1)), ("O1", dt.date(2024, 1, 2))], "order_id string, order_date date"))
    items = silver.order_items(spark.createDataFrame([("O1", 2, 10.0)], "order_id string, quantity int, total_price_usd double"))
    empty = spark.createDataFrame([], "order_id string")
    made = facts.fact_orders(orders, items, silver.payments(empty), silver.shipping(empty))
    assert [(row.total_items_quantity, float(row.total_order_value)) for row in made.collect()] == [(2, 10.0)] * 2
    assert made.first().fraud_risk_category == "unknown"


def test_newest_payment_describes_the_order(spark):
    at = [dt.datetime(2024, 1, d) for d in (1, 2)]
    raw = spark.createDataFrame(
        [("O1", "C1", "card", 10.0, at[0]), ("O1", "C2", None, 20.0, at[1]), ("O1", "C3", "cash", 5.0, None)],
        "order_id string, customer_id string, payment_method string, total_price_usd double, _ingestion_timestamp timestamp",
    )
    orders = silver.orders(spark.createDataFrame([("O1",)], "order_id string"))
    empty = spark.createDataFrame([], "order_id string")
    row = facts.fact_orders(orders, silver.order_items(empty), silver.payments(raw), silver.shipping(empty)).first()
    assert row.payment_method is None and float(row.payment_amount) == 35.0

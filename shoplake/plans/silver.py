"""Silver layer: one cleaning projection per entity.

Each function takes a bronze table (any columns, any order) and returns the cleaned table. A table is declared as the list
of its output columns, so Spark sees a single projection (plus a filter or a ranking where rows are removed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.config import METADATA
from shoplake.functions import rules as r
from shoplake.functions.shape import conform
from shoplake.operators.dedup import INGESTED, keep_latest


def _project(df: DataFrame, **columns: Column | str) -> DataFrame:
    return df.select(*((F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()))


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def _tidied(*names: str) -> dict[str, Column]:
    return {name: r.tidy(F.col(name)) for name in names}


def _cleaned(*names: str) -> dict[str, Column]:
    return {name: r.tidy_or_null(F.col(name)) for name in names}


def orders(bronze: DataFrame) -> DataFrame:
    used = r.yes_flag(F.col("coupon_used"))
    return _project(
        conform(bronze, "orders"),
        order_key=r.composite_key(F.col("order_id"), F.col("order_date")),
        **_same("order_id", "customer_id", "country", "city", "order_date"),
        **_tidied("order_status", "order_priority"),
        currency="currency",
        coupon_used=used,
        coupon_code=F.when(used == 1, F.col("coupon_code")),
        **_tidied("campaign_source"),
        **_same(INGESTED),
    )


def customers(bronze: DataFrame) -> DataFrame:
    created = F.col("account_creation_date")
    valid = (
        F.col("customer_id").isNotNull()
        & r.null_or_within(F.col("age"), 10, 100)
        & r.null_or_within(F.col("customer_loyalty_score"), 0, 100)
    )
    return _project(
        conform(bronze, "customers", metadata=False).filter(valid),
        customer_id="customer_id",
        customer_name=r.proper_case(F.col("customer_name")),
        gender=r.gender_bucket(r.tidy(F.col("gender"))),
        age="age",
        **_tidied("customer_segment", "country", "city"),
        **_same("customer_loyalty_score", "total_orders_by_customer", "account_creation_date"),
        account_year=F.year(created),
        account_month=F.month(created),
        account_day=F.dayofmonth(created),
    )


def order_items(bronze: DataFrame) -> DataFrame:
    total = r.at_least(F.col("total_price_usd"), 0)
    discount = r.not_under(F.col("discount_amount_usd"), 0)
    return _project(
        conform(bronze, "order_items"),
        **_same("order_id", "product_id", "customer_id"),
        quantity=r.above(F.col("quantity"), 0),
        unit_price_usd=r.at_least(F.col("unit_price_usd"), 0),
        discount_percent=r.within(F.col("discount_percent"), 0, 100),
        discount_amount_usd=discount,
        total_price_usd=total,
        tax_usd=r.not_under(F.col("tax_usd"), 0),
        net_revenue_usd=total - r.or_zero(discount),
        **_same("cost_usd", "profit_usd", "profit_margin_percent", INGESTED),
    )


def products(bronze: DataFrame) -> DataFrame:
    cleaned = _project(
        conform(bronze, "products"),
        product_id="product_id",
        unit_price_usd=r.at_least(F.col("unit_price_usd"), 0),
        **_cleaned("product_name", "category", "sub_category", "brand"),
        product_rating_avg=r.within(F.col("product_rating_avg"), 0, 5),
        product_reviews_count=r.at_least(F.col("product_reviews_count"), 0),
        stock_quantity=r.at_least(F.col("stock_quantity"), 0),
        **_same(*METADATA),
    )
    return keep_latest(cleaned, ["product_id"])


def payments(bronze: DataFrame) -> DataFrame:
    cleaned = _project(
        conform(bronze, "payments"),
        **_same("order_id", "customer_id"),
        **_cleaned("payment_method", "payment_status", "installment_plan"),
        fraud_risk_score=r.within(F.col("fraud_risk_score"), 0, 100),
        total_price_usd=r.at_least(F.col("total_price_usd"), 0),
        **_cleaned("currency"),
        **_same(*METADATA),
    )
    return keep_latest(cleaned, ["order_id", "customer_id"])


def reviews(bronze: DataFrame) -> DataFrame:
    # Moods, statuses and devices that are kept as they are, here and below.
    sentiment = r.one_of(r.tidy(F.col("review_sentiment")), ("positive", "negative", "neutral"), "unknown")
    return _project(
        conform(bronze, "reviews"),
        **_same("order_id", "product_id", "customer_id"),
        rating=r.within(F.col("rating"), 1, 5),
        sentiment=sentiment,
        is_positive=r.flag(sentiment == "positive"),
        is_negative=r.flag(sentiment == "negative"),
        **_same("customer_feedback", "order_date", INGESTED),
    )


def risk_support(bronze: DataFrame) -> DataFrame:
    score = r.within(F.col("fraud_risk_score"), 0, 100)
    known_statuses = ("completed", "pending", "cancelled", "returned", "processing")
    return _project(
        conform(bronze, "risk_support"),
        **_same("order_id", "customer_id"),
        fraud_risk_score=score,
        is_high_risk=r.flag(score >= 70),
        order_status=r.one_of(r.tidy(F.col("order_status")), known_statuses, "other"),
        **_tidied("return_reason"),
        has_return=r.flag(F.col("return_reason").isNotNull()),
        **_tidied("support_ticket_created"),
        has_support_ticket=r.yes_flag(F.col("support_ticket_created")),
        **_same(INGESTED),
    )


def sessions(bronze: DataFrame) -> DataFrame:
    device = r.one_of(r.tidy(F.col("device_type")), ("mobile", "desktop", "tablet"), "other")
    return _project(
        conform(bronze, "sessions"),
        **_same("order_id", "customer_id"),
        device_type=device,
        is_mobile=r.flag(device == "mobile"),
        **_tidied("traffic_source", "campaign_source"),
        session_duration_minutes=r.at_least(F.col("session_duration_minutes"), 0),
        pages_visited=r.not_under(F.col("pages_visited"), 0),
        **_same("abandoned_cart_before", INGESTED),
    )


def shipping(bronze: DataFrame) -> DataFrame:
    days = r.at_least(F.col("delivery_days"), 0)
    return _project(
        conform(bronze, "shipping"),
        **_same("order_id", "customer_id"),
        **_tidied("shipping_method"),
        shipping_cost_usd=r.at_least(F.col("shipping_cost_usd"), 0),
        delivery_days=days,
        is_delayed=r.flag(days > 7),
        **_tidied("shipping_country", "warehouse_location", "delivery_status"),
        **_same(*METADATA),
    )

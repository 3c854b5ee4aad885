"""Gold dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.functions import rules as r

# Band limits and labels.
AGE_GROUPS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64"))
LOYALTY_TIERS = ((80, "platinum"), (60, "gold"), (40, "silver"), (20, "bronze"))
PRICE_TIERS = ((20, "budget"), (50, "economy"), (100, "standard"), (200, "premium"))
PRODUCT_RATINGS = ((4.5, "excellent"), (4.0, "very_good"), (3.5, "good"), (3.0, "average"))
DAYS_PER_YEAR = 365.25


def dim_customers(customers: DataFrame, as_of: dt.date) -> DataFrame:
    tenure = F.date_diff(F.lit(as_of), "account_creation_date") / F.lit(DAYS_PER_YEAR)
    return customers.select(
        "customer_id",
        "customer_name",
        "gender",
        "age",
        r.band_below(F.col("age"), AGE_GROUPS, "65+").alias("age_group"),
        "customer_segment",
        "country",
        "city",
        "customer_loyalty_score",
        r.band_from(F.col("customer_loyalty_score"), LOYALTY_TIERS, "basic").alias("loyalty_tier"),
        "total_orders_by_customer",
        "account_creation_date",
        F.round(tenure, 1).alias("customer_tenure_years"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    stock = F.col("stock_quantity")
    stock_status = F.when(stock == 0, F.lit("out_of_stock")).otherwise(
        r.band_below(stock, ((10, "low_stock"), (50, "in_stock")), "high_stock")
    )
    rating = r.band_from(F.col("product_rating_avg"), PRODUCT_RATINGS, "not_rated", known="below_average")
    return products.select(
        "product_id",
        "product_name",
        "category",
        "sub_category",
        "brand",
        "unit_price_usd",
        r.band_below(F.col("unit_price_usd"), PRICE_TIERS, "luxury").alias("price_tier"),
        "product_rating_avg",
        rating.alias("rating_category"),
        "product_reviews_count",
        "stock_quantity",
        stock_status.alias("stock_status"),
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per date on which an order was placed, NULL included; gaps stay gaps."""
    date = F.col("date")
    quarter = F.concat(F.lit("Q"), F.quarter(date).cast("string"))
    weekend = r.flag(F.dayofweek(date).isin(1, 7))
    return (
        orders.select(F.col("order_date").alias("date"))
        .distinct()
        .select(
            "date",
            F.date_format(date, "yyyyMMdd").cast("int").alias("date_key"),
            F.year(date).alias("year"),
            F.quarter(date).alias("quarter"),
            quarter.alias("quarter_name"),
            F.concat(F.year(date).cast("string"), F.lit("-"), quarter).alias("year_quarter"),
            F.month(date).alias("month"),
            F.date_format(date, "MMMM").alias("month_name"),
            F.date_format(date, "yyyy-MM").alias("year_month"),
            F.weekofyear(date).alias("week_of_year"),
            F.dayofmonth(date).alias("day_of_month"),
            F.dayofweek(date).alias("day_of_week"),
            F.date_format(date, "EEEE").alias("day_name"),
            weekend.alias("is_weekend"),
            F.when(weekend == 1, F.lit("weekend")).otherwise(F.lit("weekday")).alias("day_type"),
            F.trunc(date, "month").alias("month_start_date"),
            F.last_day(date).alias("month_end_date"),
        )
    )

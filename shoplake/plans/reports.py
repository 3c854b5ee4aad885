"""Report queries over the gold tables. Sorting belongs here, not in the tables: order does not survive storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions import rules as r
from shoplake.functions.shape import publish
from shoplake.operators.skew import scatter_join


def _sorted(df: DataFrame, *first: Column) -> DataFrame:
    """The named sort, then every column, so that ties come out the same each time.

    Equal rows are told apart by the task they come from, so that even a large group of copies is sorted by
    several tasks.
    """
    ranked = df.withColumn("_task", F.spark_partition_id())
    return ranked.orderBy(*first, *(F.col(c) for c in df.columns), "_task").drop("_task")


def _top(df: DataFrame, limit: int, *first: Column) -> DataFrame:
    return df.orderBy(*first, *(F.col(c) for c in df.columns)).limit(limit)


def high_value_customers(agg_customer_metrics: DataFrame) -> DataFrame:
    picked = agg_customer_metrics.filter(F.col("customer_value_segment") == "high_value").select(
        "customer_id", "lifetime_value", "total_orders", "avg_order_value", "customer_value_segment"
    )
    return publish(_sorted(picked, F.col("lifetime_value").desc()))


def top_products(agg_product_performance: DataFrame, limit: int = 50) -> DataFrame:
    picked = agg_product_performance.filter(F.col("inventory_turnover_category") == "fast_moving").select(
        "product_id",
        "total_revenue",
        "total_quantity_sold",
        "avg_rating",
        "positive_review_rate",
        "inventory_turnover_category",
    )
    return publish(_top(picked, limit, F.col("total_revenue").desc_nulls_last()))


def recent_sales(agg_daily_sales: DataFrame, limit: int = 30) -> DataFrame:
    picked = agg_daily_sales.select(
        "order_date",
        "total_orders",
        "unique_customers",
        "net_revenue",
        "avg_order_value",
        "completion_rate",
        "on_time_delivery_rate",
    )
    return publish(_top(picked, limit, F.col("order_date").desc_nulls_last()))


def fraud_orders(fact_orders: DataFrame, risk_support: DataFrame) -> DataFrame:
    """Orders of high fraud risk, each with every support record it has."""
    risky = fact_orders.filter(F.col("fraud_risk_category") == "high").select(
        "order_id", "customer_id", "fraud_risk_score", "fraud_risk_category"
    )
    support = risk_support.select("order_id", "is_high_risk", "support_ticket_created")
    return publish(_sorted(scatter_join(risky, support, "order_id"), F.col("fraud_risk_score").desc()))


def shipping_methods(fact_shipping: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    late = F.count_if(F.col("is_delayed") == 1)

    def mean(name: str) -> Column:
        return F.try_divide(F.sum(name).cast("double"), F.count(name))

    summary = fact_shipping.groupBy("shipping_method").agg(
        rows.alias("shipment_count"),
        mean("delivery_days").alias("avg_delivery_days"),
        mean("shipping_cost_usd").alias("avg_cost"),
        late.alias("delayed_count"),
        r.percent(late, rows).alias("delay_rate_pct"),
    )
    return publish(_sorted(summary, F.col("shipment_count").desc()))


def daily_rollup(fact_orders: DataFrame) -> DataFrame:
    return publish(
        fact_orders.groupBy("order_date").agg(
            F.count("order_id").alias("total_orders"), F.sum("order_net_revenue").alias("total_revenue")
        )
    )


def orders_with_customers(orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Orders with the customer's attributes; those named like an order column get the prefix ``customer_``."""
    attributes = dim_customers.select(
        *(
            F.col(c).alias(c if c == "customer_id" or c not in orders.columns else f"customer_{c}")
            for c in dim_customers.columns
        )
    )
    return publish(scatter_join(orders, attributes, "customer_id"))

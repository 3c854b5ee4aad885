"""Daily sales kept up by change.

Every measure is a sum, a count, a mean of both, or a number of distinct customers. Sums and counts are states that add up, also with a sign; for
the customers the state is how many orders each has on a day. A change of the facts is a bag of signed rows: rows of the new
version that the old one lacks, and rows of the old one that are gone. Its states, added to the stored ones, give the same table as
a rebuild, and a refresh writes only states of days and customers that changed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions import rules as r
from shoplake.session import clear_scratch, scratch_dir
from shoplake.sources.lake import Lake

SIGN = "_sign"
# Measures by how they follow from the facts: sums, means of two digits, and counts of rows with a value.
_SUMS = {
    "gross_revenue": "order_gross_amount",
    "total_discounts": "order_discount_amount",
    "net_revenue": "order_net_revenue",
    "total_shipping_revenue": "shipping_cost",
    "total_revenue": "total_order_value",
    "total_items_sold": "total_items_quantity",
    "total_line_items": "total_line_items",
    "delayed_deliveries": "is_delayed",
}
_MEANS = {
    "avg_order_value": "total_order_value",
    "avg_net_revenue": "order_net_revenue",
    "avg_items_per_order": "total_line_items",
    "avg_fraud_risk_score": "fraud_risk_score",
}
_COUNTS = {
    "completed_orders": ("order_status", "completed"),
    "cancelled_orders": ("order_status", "cancelled"),
    "pending_orders": ("order_status", "pending"),
    "successful_payments": ("payment_status", "completed"),
    "failed_payments": ("payment_status", "failed"),
}
_USED = ["order_date", "order_id", "customer_id", *dict.fromkeys([*_SUMS.values(), *_MEANS.values(), *(c for c, _ in _COUNTS.values())])]
_MEASURED = list(dict.fromkeys([*_SUMS.values(), *_MEANS.values()]))


def signed_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The difference of two bags of rows: each row with how many times more (or, below zero, fewer) the new one has it.

    Rows need no key. Both bags meet in one aggregation over whole rows.
    """
    both = new.withColumn(SIGN, F.lit(1).cast("long")).unionByName(old.withColumn(SIGN, F.lit(-1).cast("long")))
    return both.groupBy(*new.columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0)


def _exact(name: str) -> Column:
    """Scores are doubles; as decimals their sums do not depend on order, so that what was added can be taken away again."""
    return F.col(name).cast("decimal(28,10)") if name == "fraud_risk_score" else F.col(name)


def day_states(changes: DataFrame) -> DataFrame:
    """Per day, the signed sums and counts of changed facts."""
    sign = F.col(SIGN)
    sums = [F.sum(_exact(c) * sign).alias(f"sum_{c}") for c in _MEASURED]
    counts = [F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(f"n_{c}") for c in [*_MEASURED, "order_id"]]
    hits = [F.sum(F.when(F.col(c) == value, sign).otherwise(0)).alias(name) for name, (c, value) in _COUNTS.items()]
    return changes.groupBy("order_date").agg(F.sum(sign).alias("n_rows"), *sums, *counts, *hits)


def customer_states(changes: DataFrame) -> DataFrame:
    """Per day and customer, the signed number of orders."""
    return changes.filter("customer_id IS NOT NULL").groupBy("order_date", "customer_id").agg(F.sum(SIGN).alias("n_orders"))


def daily_sales(days: DataFrame, customers: DataFrame) -> DataFrame:
    """The table ``agg_daily_sales`` from states, of which a day may have several."""
    held = customers.groupBy("order_date", "customer_id").agg(F.sum("n_orders").alias("n")).filter("n > 0")
    unique = held.groupBy("order_date").agg(F.count(F.lit(1)).alias("unique_customers"))
    added = days.groupBy("order_date").agg(*(F.sum(c).alias(c) for c in days.columns if c != "order_date")).filter("n_rows > 0")
    unique = unique.select(F.col("order_date").alias("_day"), "unique_customers")
    all_ = added.join(unique, F.col("order_date").eqNullSafe(F.col("_day")), "left")

    def total(column: str) -> Column:
        return F.when(F.col(f"n_{column}") > 0, F.col(f"sum_{column}"))

    def mean(column: str) -> Column:
        return F.round(F.col(f"sum_{column}").cast("decimal(38,10)") / F.nullif(F.col(f"n_{column}"), F.lit(0)), 2)

    orders, late = F.col("n_order_id"), total("is_delayed")
    return all_.select(
        "order_date",
        orders.alias("total_orders"),
        F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"),
        *(total(c).alias(name) for name, c in _SUMS.items()),
        *(mean(c).alias(name) for name, c in _MEANS.items()),
        *_COUNTS,
        r.percent(F.col("completed_orders"), orders).alias("completion_rate"),
        r.percent(F.col("cancelled_orders"), orders).alias("cancellation_rate"),
        r.percent(orders - late, orders).alias("on_time_delivery_rate"),
    )


# --- stored states -------------------------------------------------------------------------------------------------------
def _states(lake: Lake, kind: str) -> DataFrame:
    """States of all complete generations. A generation's mark is written last, so an interrupted one does not count."""
    done = lake.spark.read.schema("generation int").option("recursiveFileLookup", "true").parquet(lake.path("daily_states", "done"))
    found = lake.spark.read.parquet(lake.path("daily_states", kind))
    return found.join(F.broadcast(done), "generation", "left_semi").drop("generation")


def refreshed_version(lake: Lake) -> int:
    """The version of the facts that the stored states stand for; -1 where there is none."""
    marks = lake.path("daily_states", "done")
    if not lake.has(marks):
        return -1
    newest = lake.spark.read.schema("generation int").option("recursiveFileLookup", "true").parquet(marks).agg(F.max("generation")).first()[0]
    return -1 if newest is None else newest


def refresh_daily_sales(lake: Lake) -> bool:
    """Bring the stored states to the newest version of ``fact_orders``; a generation is numbered by the version it leads to.

    The version they stand for must still be stored. Repeating an interrupted refresh replaces what it wrote.
    """
    since, version = refreshed_version(lake), lake.version("fact_orders")
    if version <= since:
        return False
    new = lake.table("fact_orders").select(*_USED)
    scratch = []
    if since < 0:
        # Before the first version there was nothing, so every row is a change.
        changes = new.withColumn(SIGN, F.lit(1).cast("long"))
    else:
        old = lake.spark.read.parquet(lake.path("tables", "fact_orders", f"version={since}")).select(*_USED)
        # Both bags meet once; what differs is kept until both states are made of it.
        scratch.append(scratch_dir(lake.spark, "changes"))
        signed_changes(old, new).write.parquet(scratch[0])
        changes = lake.spark.read.parquet(scratch[0])
    for kind, made in (("days", day_states(changes)), ("customers", customer_states(changes))):
        made.write.mode("overwrite").parquet(lake.path("daily_states", kind, f"generation={version}"))
    clear_scratch(lake.spark, scratch)
    mark = lake.spark.createDataFrame([(version,)], "generation int").coalesce(1)
    mark.write.mode("overwrite").parquet(lake.path("daily_states", "done", f"generation={version}"))
    return True


def refreshed_daily_sales(lake: Lake) -> DataFrame:
    """``agg_daily_sales`` as of the last refresh."""
    return daily_sales(_states(lake, "days"), _states(lake, "customers"))


def monthly_customers(customers: DataFrame) -> DataFrame:
    """Distinct customers of each month, from the states of its days; the facts are not read again."""
    month = F.trunc("order_date", "month").alias("month")
    held = customers.groupBy(month, "customer_id").agg(F.sum("n_orders").alias("n")).filter("n > 0")
    return held.groupBy("month").agg(F.count(F.lit(1)).alias("unique_customers"))

"""Entity tables derived from the TPC-H style sample tables, with planted dirt.

The sample data is clean; these projections add NULLs, out-of-range numbers, padding, mixed case, repeated versions and
rows without a partner, always over the whole table. The select lists use only syntax that other SQL engines
share, so a checker can evaluate the same text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SELECTS: dict[str, str] = {
    "customers": """
  CASE WHEN c_custkey % 97 = 96 THEN NULL ELSE CAST(c_custkey AS STRING) END AS customer_id,
  '  ' || upper(c_name) || ' ' AS customer_name,
  CASE c_custkey % 5 WHEN 0 THEN ' Male ' WHEN 1 THEN 'FEMALE' WHEN 3 THEN 'nonbinary' WHEN 4 THEN 'female' END AS gender,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(5 + c_custkey % 110 AS INT) END AS age,
  ' ' || c_mktsegment AS customer_segment, n_name AS country, r_name || ' ' AS city,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal / 95 END AS customer_loyalty_score,
  CAST(c_custkey % 20 AS INT) AS total_orders_by_customer,
  DATE '1990-01-01' + CAST(c_custkey % 3000 AS INT) AS account_creation_date""",
    "orders": """
  CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
  'Country' || CAST(o_custkey % 25 AS STRING) AS country, 'City' || CAST(o_custkey % 40 AS STRING) AS city,
  CAST(o_orderdate AS DATE) AS order_date,
  CASE WHEN o_orderstatus = 'F' THEN ' Completed ' WHEN o_orderstatus = 'O' THEN 'PENDING'
       WHEN o_orderkey % 2 = 0 THEN 'cancelled' ELSE 'Refunded' END AS order_status,
  ' ' || o_orderpriority AS order_priority, 'USD' AS currency,
  CASE o_orderkey % 3 WHEN 0 THEN 'Yes ' WHEN 1 THEN 'no' END AS coupon_used,
  CASE WHEN o_orderkey % 6 = 3 THEN NULL WHEN o_orderkey % 47 = 0 THEN '-'
       ELSE 'C' || CAST(o_orderkey % 50 AS STRING) END AS coupon_code,
  CASE o_orderkey % 4 WHEN 0 THEN 'Email' WHEN 1 THEN ' ADS' WHEN 2 THEN 'organic' END AS campaign_source""",
    "order_items": """
  CAST(l_orderkey AS STRING) AS order_id, CAST(l_partkey AS STRING) AS product_id, CAST(o_custkey AS STRING) AS customer_id,
  CAST(l_quantity AS INT) - 2 AS quantity,
  CASE WHEN l_partkey % 41 = 0 THEN CAST(-1 AS DECIMAL(18,2)) ELSE CAST(p_size * 5 AS DECIMAL(18,2)) END AS unit_price_usd,
  CAST(round(l_discount * 100) AS INT) * 11 AS discount_percent,
  CAST(CAST(round(l_discount * 100) AS INT) * l_linenumber * 10 - 20 AS DECIMAL(18,2)) AS discount_amount_usd,
  CASE WHEN l_partkey % 59 = 0 THEN CAST(-5 AS DECIMAL(18,2))
       WHEN l_linenumber = 4 THEN CAST(l_quantity AS INT) * CAST(p_size * 5 AS DECIMAL(18,2))
       ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS total_price_usd,
  CAST(CAST(round(l_tax * 100) AS INT) - 1 AS DECIMAL(18,2)) AS tax_usd,
  CAST(p_retailprice AS DECIMAL(18,2)) AS cost_usd,
  CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(p_retailprice AS DECIMAL(18,2)) AS profit_usd,
  CAST(round(l_tax * 100) AS INT) * 4 AS profit_margin_percent""",
    "products": """
  CAST(p_partkey AS STRING) AS product_id,
  CASE WHEN p_partkey % 43 = 0 THEN CAST(-1 AS DECIMAL(18,2)) ELSE CAST(p_size * 5 + v AS DECIMAL(18,2)) END AS unit_price_usd,
  upper(p_name) || ' ' AS product_name, p_type AS category,
  CASE WHEN p_partkey % 7 = 0 THEN '   ' ELSE ' Sub' || CAST(p_size AS STRING) END AS sub_category, p_brand AS brand,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE (CAST(p_partkey % 70 AS DOUBLE) - 5) / 10 END AS product_rating_avg,
  CAST(p_partkey % 300 AS INT) - 5 AS product_reviews_count, CAST(p_partkey % 120 AS INT) - 5 AS stock_quantity,
  v AS load_seq""",
    "payments": """
  'P' || CAST(o_orderkey AS STRING) AS payment_id,
  CASE WHEN o_orderkey % 23 = 0 THEN 'unknown-' ELSE '' END || CAST(o_orderkey AS STRING) AS order_id,
  CAST(o_custkey AS STRING) AS customer_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'Card ' WHEN 1 THEN 'PAYPAL' WHEN 2 THEN ' ' ELSE 'cash' END AS payment_method,
  CASE WHEN v = 1 OR o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN ' FAILED' ELSE '' END AS payment_status,
  CASE WHEN o_orderkey % 6 = 0 THEN 'Monthly' END AS installment_plan,
  CAST(o_orderkey * 7 % 120 - 5 AS DOUBLE) AS fraud_risk_score,
  CASE WHEN o_orderkey % 53 = 0 THEN CAST(-1 AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS total_price_usd,
  'usd ' AS currency, v AS load_seq""",
    "shipping": """
  'S' || CAST(o_orderkey AS STRING) AS shipping_id,
  CASE WHEN o_orderkey % 17 = 0 THEN 'unknown-' ELSE '' END || CAST(o_orderkey AS STRING) AS order_id,
  CAST(o_custkey AS STRING) AS customer_id,
  CASE (o_orderkey + v) % 3 WHEN 0 THEN 'Express ' WHEN 1 THEN 'GROUND' ELSE 'air' END AS shipping_method,
  CASE WHEN o_orderkey % 37 = 0 THEN CAST(-3 AS DECIMAL(18,2)) ELSE CAST(o_orderkey % 25 AS DECIMAL(18,2)) END AS shipping_cost_usd,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_orderkey % 15 - 1 AS INT) + v END AS delivery_days,
  CASE WHEN v = 1 THEN 'Returned' ELSE ' Delivered' END AS delivery_status,
  'Country' || CAST(o_custkey % 25 AS STRING) AS shipping_country, 'WH' || CAST(o_orderkey % 6 AS STRING) AS warehouse_location,
  v AS load_seq""",
    "reviews": """
  CAST(l_orderkey AS STRING) AS order_id, CAST(l_partkey AS STRING) AS product_id, CAST(o_custkey AS STRING) AS customer_id,
  CAST(l_quantity AS INT) % 7 AS rating,
  CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_returnflag = 'A' THEN ' Positive ' WHEN l_returnflag = 'N' THEN 'neutral'
       WHEN l_linenumber = 1 THEN 'mixed' ELSE 'NEGATIVE' END AS review_sentiment,
  'feedback ' || l_linestatus AS customer_feedback, CAST(o_orderdate AS DATE) AS order_date""",
    "sessions": """
  CAST(event_id AS STRING) AS session_id, CAST(event_id AS STRING) AS order_id, CAST(user_id AS STRING) AS customer_id,
  CASE event_id % 5 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'desktop ' WHEN 2 THEN ' TABLET' WHEN 3 THEN 'smart-tv' END AS device_type,
  event_type AS traffic_source, CASE event_id % 3 WHEN 0 THEN 'Email ' WHEN 1 THEN 'ads' END AS campaign_source,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(value AS DECIMAL(18,2)) - CAST(3 AS DECIMAL(18,2)) END AS session_duration_minutes,
  CAST(event_id % 22 AS INT) - 2 AS pages_visited, CASE WHEN event_id % 2 = 0 THEN 'Yes' ELSE 'No' END AS abandoned_cart_before""",
    "risk_support": """
  'R' || CAST(o_orderkey AS STRING) AS risk_id,
  CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
  CAST((o_orderkey * 11 + CASE WHEN v = 0 THEN 0 ELSE 30 END) % 125 - 10 AS DOUBLE) AS fraud_risk_score,
  CASE o_orderkey % 7 WHEN 0 THEN ' Completed' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'cancelled' WHEN 3 THEN 'Returned'
       WHEN 4 THEN 'processing' WHEN 5 THEN 'lost' END AS order_status,
  CASE WHEN o_orderkey % 9 = 0 THEN ' Damaged' END AS return_reason,
  CASE o_orderkey % 4 WHEN 0 THEN 'Yes ' WHEN 1 THEN 'no' WHEN 2 THEN 'maybe' END AS support_ticket_created, v AS load_seq""",
}

# Versions (load numbers) of a row, as an array. Version 0 exists for every row.
VERSIONS: dict[str, str] = {
    "products": "CASE WHEN p_partkey % 10 = 0 THEN array(0, 1) ELSE array(0) END",
    "payments": "CASE WHEN o_orderkey % 10 = 0 THEN array(0, 1) ELSE array(0) END",
    "shipping": "CASE WHEN o_orderkey % 20 = 0 THEN array(0, 1) ELSE array(0) END",
    "risk_support": "CASE WHEN o_orderkey % 10 = 0 THEN array(0, 1, 2) WHEN o_orderkey % 5 = 0 THEN array(0, 1) ELSE array(0) END",
}

FIRST_LOAD = "TIMESTAMP '2024-01-01 00:00:00'"

Read = Callable[[str], DataFrame]


def reader(spark: SparkSession, sf_dir: str) -> Read:
    """Reads each sample table once."""
    seen: dict[str, DataFrame] = {}

    def read(name: str) -> DataFrame:
        if name not in seen:
            seen[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return seen[name]

    return read


def _source(read: Read, entity: str) -> DataFrame:
    if entity == "customers":
        nations = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return read("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    if entity == "order_items":
        # Orders come last, by the text that becomes the order id: rows stay laid out by it, so a job that needs them so has no shuffle left.
        lines = read("lineitem").join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
        return lines.join(read("orders"), F.col("l_orderkey").cast("string") == F.col("o_orderkey").cast("string"))
    if entity == "reviews":
        return read("lineitem").join(read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if entity == "sessions":
        return read("events")
    return read("part" if entity == "products" else "orders")


def _versioned(read: Read, entity: str) -> DataFrame:
    source = _source(read, entity)
    return source.withColumn("v", F.explode(F.expr(VERSIONS[entity]))) if entity in VERSIONS else source


def raw_entity(read: Read, entity: str) -> DataFrame:
    """The entity as its source files would hold it, ``load_seq`` included where rows have versions."""
    source = _versioned(read, entity)
    return source.sparkSession.sql(f"SELECT {SELECTS[entity]} FROM {{source}}", source=source)


def bronze_entity(read: Read, entity: str) -> DataFrame:
    """The entity as landed: with load metadata; version n was loaded on day n."""
    source = _versioned(read, entity)
    day = "v" if entity in VERSIONS else "0"
    landed = source.sparkSession.sql(
        f"""SELECT {SELECTS[entity]}, {FIRST_LOAD} + make_dt_interval({day}) AS _ingestion_timestamp,
  'sample' AS _source_file, 'full_load' AS _load_type FROM {{source}}""",
        source=source,
    )
    return landed.drop("load_seq")

"""SQL for every registered query."""

from __future__ import annotations

from oracle.tables import TABLES, as_doubles, pct, with_tables

# Decimal columns that queries publish as doubles.
_MONEY: dict[str, tuple[str, ...]] = {
    "orders_silver": (),
    "customers_silver": (),
    "order_items_silver": (
        "unit_price_usd", "discount_amount_usd", "total_price_usd", "tax_usd", "net_revenue_usd", "cost_usd", "profit_usd",
    ),
    "products_silver": ("unit_price_usd",),
    "payments_silver": ("total_price_usd",),
    "reviews_silver": (),
    "risk_support_silver": (),
    "sessions_silver": ("session_duration_minutes",),
    "dim_customers": (),
    "dim_products": ("unit_price_usd",),
    "dim_date": (),
    "fact_orders": (
        "order_gross_amount", "order_discount_amount", "order_tax_amount", "order_net_revenue", "shipping_cost", "total_order_value",
        "payment_amount",
    ),
    "fact_order_items": (
        "unit_price_usd", "discount_amount_usd", "discount_percentage", "total_price_usd", "tax_usd", "net_revenue_usd",
        "revenue_per_unit", "cost_usd", "profit_usd",
    ),
    "fact_sessions": ("session_duration_minutes", "engagement_score"),
    "fact_reviews": (),
    "fact_shipping": ("shipping_cost_usd", "shipping_cost_per_day"),
    "agg_daily_sales": (
        "gross_revenue", "total_discounts", "net_revenue", "total_shipping_revenue", "total_revenue", "avg_order_value", "avg_net_revenue",
        "avg_items_per_order", "avg_fraud_risk_score", "completion_rate", "cancellation_rate", "on_time_delivery_rate",
    ),
    "agg_customer_metrics": (
        "lifetime_value", "lifetime_net_revenue", "avg_order_value", "avg_net_revenue", "avg_engagement_score", "avg_rating_given",
    ),
    "agg_product_performance": (
        "unit_price_usd", "total_revenue", "total_discounts_given", "avg_selling_price", "avg_discount_percentage", "avg_rating",
        "revenue_per_unit", "positive_review_rate", "product_performance_score",
    ),
}

_RAW_ITEM_MONEY = ("unit_price_usd", "discount_amount_usd", "total_price_usd", "tax_usd", "cost_usd", "profit_usd")
_RAW_ITEM_DOUBLES = (*_RAW_ITEM_MONEY, "discount_percent", "profit_margin_percent")

_WIDE_ORDERS = """
SELECT *, CAST(NULL AS INTEGER) AS age, CASE WHEN CAST(order_id AS BIGINT) % 50 = 0 THEN 'L' END AS legacy_code,
  CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN '-' END AS gift_note FROM orders_bronze"""
_ORDER_COLUMNS = (
    "order_id", "customer_id", "country", "city", "order_date", "order_status", "order_priority", "currency", "coupon_used", "coupon_code",
    "campaign_source",
)
_ORDER_STRINGS = tuple(c for c in _ORDER_COLUMNS if c != "order_date")


def _union(rows: list[str]) -> str:
    return "\nUNION ALL ".join(rows)


_EXPECTATIONS = {
    "valid_total": "total_price_usd > 0",
    "has_customer": "customer_id IS NOT NULL",
    "valid_quantity": "quantity > 0",
}
_RANGES = {
    "invalid_price": "unit_price_usd < 0",
    "rating_below_0": "product_rating_avg < 0",
    "rating_above_5": "product_rating_avg > 5",
    "negative_reviews": "product_reviews_count < 0",
    "negative_stock": "stock_quantity < 0",
}


def _scd2(entity: str, key: str, tracked: str, columns: str) -> str:
    return f"""
SELECT {columns}, CAST(DATE '2024-01-01' + load_seq AS DATE) AS __start_date,
  CAST(DATE '2024-01-01' + lead(load_seq) OVER (PARTITION BY {key} ORDER BY load_seq) AS DATE) AS __end_date
FROM (SELECT * FROM {entity}_bronze
      QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY load_seq) = 1
        OR NOT (lag(row({tracked})) OVER (PARTITION BY {key} ORDER BY load_seq) IS NOT DISTINCT FROM row({tracked})))"""


_PRODUCT_COLUMNS = (
    "unit_price_usd, product_name, category, sub_category, brand, product_rating_avg, product_reviews_count, stock_quantity"
)
_PRODUCT_VERSIONS = _scd2(
    "products",
    "product_id",
    _PRODUCT_COLUMNS,
    "product_id, " + _PRODUCT_COLUMNS.replace("unit_price_usd", "CAST(unit_price_usd AS DOUBLE) AS unit_price_usd"),
)
_RISK_COLUMNS = "order_id, customer_id, fraud_risk_score, order_status, return_reason, support_ticket_created"

_AUDIT = """
SELECT count(*) FILTER (abs(total_price_usd - ({total})) > 0.01) AS total_price_mismatch,
  count(*) FILTER (abs(profit_usd - (total_price_usd - cost_usd)) > 0.01) AS profit_mismatch,
  count(*) FILTER (abs(profit_margin_percent - CAST(profit_usd AS DOUBLE) / nullif(CAST(total_price_usd AS DOUBLE), 0) * 100) > 0.1)
    AS margin_mismatch
FROM order_items_bronze"""

_LATEST = "QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY load_seq DESC) = 1"

_UPSERTED = {
    "payments_silver": TABLES["payments_silver"],
    "shipping_silver": TABLES["shipping_silver"].replace(
        "FROM shipping_bronze", f"FROM (SELECT * FROM shipping_bronze {_LATEST.format(key='shipping_id')})"
    ),
}

_BODIES: dict[str, str] = {
    **{name: f"SELECT {as_doubles(*money)} FROM {name}" for name, money in _MONEY.items()},
    "shipping_silver": "SELECT * EXCLUDE (load_seq) REPLACE (CAST(shipping_cost_usd AS DOUBLE) AS shipping_cost_usd) FROM shipping_silver",
    "report_high_value_customers": """
SELECT customer_id, CAST(lifetime_value AS DOUBLE) AS lifetime_value, total_orders, CAST(avg_order_value AS DOUBLE) AS avg_order_value,
  customer_value_segment FROM agg_customer_metrics WHERE customer_value_segment = 'high_value' ORDER BY lifetime_value DESC""",
    "report_top_products": """
SELECT product_id, CAST(total_revenue AS DOUBLE) AS total_revenue, total_quantity_sold, CAST(avg_rating AS DOUBLE) AS avg_rating,
  CAST(positive_review_rate AS DOUBLE) AS positive_review_rate, inventory_turnover_category
FROM agg_product_performance WHERE inventory_turnover_category = 'fast_moving' ORDER BY total_revenue DESC NULLS LAST, product_id LIMIT 50""",
    "report_recent_sales": """
SELECT order_date, total_orders, unique_customers, CAST(net_revenue AS DOUBLE) AS net_revenue, CAST(avg_order_value AS DOUBLE) AS avg_order_value,
  CAST(completion_rate AS DOUBLE) AS completion_rate, CAST(on_time_delivery_rate AS DOUBLE) AS on_time_delivery_rate
FROM agg_daily_sales ORDER BY order_date DESC NULLS LAST LIMIT 30""",
    "report_fraud": """
SELECT o.order_id, o.customer_id, o.fraud_risk_score, o.fraud_risk_category, r.is_high_risk, r.support_ticket_created
FROM fact_orders o LEFT JOIN risk_support_silver r ON o.order_id = r.order_id WHERE o.fraud_risk_category = 'high'""",
    "report_shipping_methods": f"""
SELECT shipping_method, count(*) AS shipment_count, CAST(sum(delivery_days) AS DOUBLE) / count(delivery_days) AS avg_delivery_days,
  CAST(sum(shipping_cost_usd) AS DOUBLE) / count(shipping_cost_usd) AS avg_cost, CAST(sum(is_delayed) AS BIGINT) AS delayed_count,
  CAST({pct("sum(is_delayed)", "count(*)")} AS DOUBLE) AS delay_rate_pct
FROM fact_shipping GROUP BY shipping_method""",
    "report_daily_rollup": """
SELECT order_date, count(order_id) AS total_orders, CAST(sum(order_net_revenue) AS DOUBLE) AS total_revenue FROM fact_orders GROUP BY order_date""",
    "orders_with_customers": """
SELECT o.*, c.customer_name, c.gender, c.age, c.age_group, c.customer_segment, c.country AS customer_country, c.city AS customer_city,
  c.customer_loyalty_score, c.loyalty_tier, c.total_orders_by_customer, c.account_creation_date, c.customer_tenure_years
FROM orders_silver o LEFT JOIN dim_customers c ON o.customer_id = c.customer_id""",
    "profile_nulls": _union(
        [f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows FROM wide_orders"
         for c in (*_ORDER_COLUMNS, "age", "legacy_code", "gift_note")]
        + [f"SELECT '{c}', 0" for c in ("_ingestion_timestamp", "_source_file", "_load_type")]
    ),
    "profile_sentinels": _union(
        [f"SELECT '{c}' AS column_name, count(*) FILTER ({c} = '-') AS sentinel_rows FROM wide_orders"
         for c in (*_ORDER_STRINGS, "legacy_code", "gift_note")]
        + [f"SELECT '{c}', 0" for c in ("_source_file", "_load_type")]
    ),
    "prune_sparse_10pct": "SELECT * EXCLUDE (age, legacy_code) FROM wide_orders",
    "prune_sparse_95pct": f"""
SELECT {as_doubles(*_RAW_ITEM_MONEY)}, CASE WHEN CAST(product_id AS BIGINT) % 10 = 0 THEN 'R' END AS rare_code FROM order_items_bronze""",
    "duplicate_keys": "SELECT order_id, count(*) AS row_count FROM risk_support_bronze GROUP BY order_id HAVING count(*) > 1",
    "duplicate_rows": """
SELECT customer_id, device_type, traffic_source, campaign_source, pages_visited, abandoned_cart_before, count(*) AS row_count
FROM sessions_bronze GROUP BY ALL HAVING count(*) > 1""",
    "key_cardinality": """
SELECT count(*) AS total_rows, count(DISTINCT customer_id) + max(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS distinct_keys
FROM customers_bronze""",
    "range_violations": _union([f"SELECT '{n}' AS rule, count(*) FILTER ({r}) AS row_count FROM products_bronze" for n, r in _RANGES.items()]),
    "range_violation_rows": "SELECT product_id, concat_ws(',', "
    + ", ".join(f"CASE WHEN {r} THEN '{n}' END" for n, r in _RANGES.items())
    + ") AS broken_rules FROM products_bronze WHERE "
    + " OR ".join(f"coalesce({r}, FALSE)" for r in _RANGES.values()),
    "retained_in_range": """
SELECT 'age' AS rule, count(*) AS row_count FROM customers_bronze WHERE age IS NULL OR (age >= 10 AND age <= 100)
UNION ALL SELECT 'customer_loyalty_score', count(*) FROM customers_bronze
WHERE customer_loyalty_score IS NULL OR (customer_loyalty_score >= 0 AND customer_loyalty_score <= 100)""",
    "column_summary": _union(
        [f"""SELECT '{c}' AS column_name, count({c}) AS non_null_rows, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
  CAST(min({c}) AS DOUBLE) AS min_number, CAST(max({c}) AS DOUBLE) AS max_number, CAST(NULL AS VARCHAR) AS min_text,
  CAST(NULL AS VARCHAR) AS max_text FROM customers_bronze""" for c in ("age", "customer_loyalty_score", "total_orders_by_customer")]
        + [f"""SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, CAST(min({c}) AS VARCHAR), CAST(max({c}) AS VARCHAR) FROM customers_bronze"""
           for c in ("account_creation_date", "customer_segment")]
    ),
    "domain_values": _union(
        [f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM orders_bronze GROUP BY {c}"
         for c in ("order_status", "order_priority", "coupon_used", "campaign_source")]
    ),
    "domain_combinations": "SELECT country, city, count(*) AS row_count FROM customers_silver GROUP BY country, city",
    "amount_audit": _AUDIT.format(total="quantity * unit_price_usd"),
    "amount_audit_discount": _AUDIT.format(total="quantity * unit_price_usd - discount_amount_usd"),
    "amount_repair": f"""
SELECT order_id, product_id, customer_id, quantity, CAST(unit_price_usd AS DOUBLE) AS unit_price_usd, CAST(discount_percent AS DOUBLE) AS discount_percent,
  CAST(discount_amount_usd AS DOUBLE) AS discount_amount_usd, CAST(total AS DOUBLE) AS total_price_usd, CAST(tax_usd AS DOUBLE) AS tax_usd,
  CAST(cost_usd AS DOUBLE) AS cost_usd, CAST(total - cost_usd AS DOUBLE) AS profit_usd,
  CAST({pct("total - cost_usd", "total")} AS DOUBLE) AS profit_margin_percent
FROM (SELECT *, quantity * unit_price_usd - discount_amount_usd AS total FROM order_items_bronze)""",
    "coupon_audit": """
SELECT *, CASE WHEN coupon_used = 0 THEN 'code_without_use' ELSE 'use_without_code' END AS violation
FROM (SELECT order_id, CASE WHEN lower(trim(coupon_used)) = 'yes' THEN 1 ELSE 0 END AS coupon_used, coupon_code FROM orders_bronze)
WHERE (coupon_used = 0 AND coupon_code IS NOT NULL) OR (coupon_used = 1 AND coupon_code IS NULL)""",
    "future_dates": "SELECT * FROM orders_bronze WHERE order_date > DATE '2001-01-01'",
    "order_lookup": "SELECT * FROM orders_bronze WHERE order_id = '914'",
    "customers_proper_case": "SELECT * REPLACE ("
    + ", ".join(
        f"array_to_string(list_transform(string_split(lower(trim({c})), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS {c}"
        for c in ("customer_name", "gender", "customer_segment", "country", "city")
    )
    + ") FROM customers_bronze",
    "key_exists": "SELECT count(*) > 0 AS key_exists FROM orders_bronze WHERE customer_id IS NOT NULL",
    "scd1_orders": "SELECT * REPLACE (CASE WHEN order_status = 'PENDING' THEN 'completed' ELSE order_status END AS order_status) FROM orders_bronze",
    "scd1_payments": f"""
SELECT * EXCLUDE (load_seq) REPLACE (CAST(total_price_usd AS DOUBLE) AS total_price_usd) FROM payments_bronze {_LATEST.format(key="payment_id")}""",
    "scd1_shipping": f"""
SELECT * EXCLUDE (load_seq) REPLACE (CAST(shipping_cost_usd AS DOUBLE) AS shipping_cost_usd) FROM shipping_bronze {_LATEST.format(key="shipping_id")}""",
    "scd2_products": _PRODUCT_VERSIONS,
    "scd2_risk_support": _scd2("risk_support", "risk_id", _RISK_COLUMNS, "risk_id, " + _RISK_COLUMNS),
    "scd2_as_of": f"""
SELECT i.order_id, i.product_id, i.quantity, p.unit_price_usd AS list_price_usd, p.__end_date IS NULL AS is_current
FROM order_items_bronze i
LEFT JOIN ({_PRODUCT_VERSIONS}) p ON i.product_id = p.product_id AND p.__start_date <= DATE '2024-01-01' + i.quantity % 2
  AND (p.__end_date IS NULL OR DATE '2024-01-01' + i.quantity % 2 < p.__end_date)""",
    "change_feed": """
SELECT product_id, CASE WHEN o.product_id IS NULL THEN 'insert' WHEN n.product_id IS NULL THEN 'delete' ELSE 'update' END AS change_type,
  CAST(CASE WHEN n.product_id IS NULL THEN o.unit_price_usd ELSE n.unit_price_usd END AS DOUBLE) AS unit_price_usd,
  coalesce(n.product_name, o.product_name) AS product_name, coalesce(n.category, o.category) AS category,
  coalesce(n.sub_category, o.sub_category) AS sub_category, coalesce(n.brand, o.brand) AS brand,
  CASE WHEN n.product_id IS NULL THEN o.product_rating_avg ELSE n.product_rating_avg END AS product_rating_avg,
  coalesce(n.product_reviews_count, o.product_reviews_count) AS product_reviews_count, coalesce(n.stock_quantity, o.stock_quantity) AS stock_quantity
FROM (SELECT * FROM products_bronze WHERE load_seq = 0 AND product_rating_avg IS NOT NULL) o
FULL JOIN (SELECT * FROM (SELECT * FROM products_bronze QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY load_seq DESC) = 1)
           WHERE stock_quantity > 0) n USING (product_id)
WHERE o.product_id IS NULL OR n.product_id IS NULL OR o.unit_price_usd IS DISTINCT FROM n.unit_price_usd
  OR o.product_rating_avg IS DISTINCT FROM n.product_rating_avg""",
    "expect_warn": _union(
        [f"SELECT '{n}' AS expectation, count(*) AS total_rows, count(*) FILTER ({r}) AS passed_rows, "
         f"count(*) - count(*) FILTER ({r}) AS failed_rows FROM order_items_bronze" for n, r in _EXPECTATIONS.items()]
    ),
    "expect_drop": f"SELECT {as_doubles(*_RAW_ITEM_DOUBLES)} FROM order_items_bronze WHERE " + " AND ".join(f"({r})" for r in _EXPECTATIONS.values()),
    "expect_fail": f"SELECT {as_doubles(*_RAW_ITEM_DOUBLES)} FROM order_items_bronze",
    "expect_fail_caught": _union(
        [f"SELECT '{n}' AS expectation, f AS failed_rows FROM (SELECT count(*) FILTER (NOT coalesce({r}, FALSE)) AS f FROM order_items_bronze) WHERE f > 0" for n, r in _EXPECTATIONS.items()]
    ),
    "expect_enforced": f"SELECT {as_doubles(*_RAW_ITEM_DOUBLES)} FROM order_items_bronze",
}

_RAW_PRODUCTS = "* EXCLUDE (load_seq) REPLACE (CAST(unit_price_usd AS DOUBLE) AS unit_price_usd)"

_BODIES.update(
    {
        "bronze_full_load": f"SELECT {_RAW_PRODUCTS}, 'full_load' AS load_type FROM products_bronze",
        "bronze_full_load_all": _union(
            [f"SELECT '{e}' AS entity, 'full_load' AS load_type, count(*) AS row_count FROM {e}_bronze"
             for e in ("customers", "orders", "order_items", "products", "payments", "reviews", "risk_support", "sessions", "shipping")]
        ),
        "bronze_stream": "SELECT *, 'incremental' AS load_type FROM orders_bronze",
        "bronze_schema_evolution": """
SELECT * REPLACE (CAST(session_duration_minutes AS DOUBLE) AS session_duration_minutes,
    CASE WHEN traffic_source IN ('view', 'click') THEN abandoned_cart_before END AS abandoned_cart_before),
  CASE WHEN traffic_source NOT IN ('view', 'click') THEN 'ref-' || customer_id END AS referrer_code, 'incremental' AS load_type
FROM sessions_bronze""",
        "bronze_fan_in": """
SELECT * EXCLUDE (load_seq), CASE WHEN load_seq = 0 THEN 'full_load' ELSE 'incremental' END AS load_type FROM risk_support_bronze""",
        "expect_stream_quarantine": """
SELECT order_id, product_id, quantity, CAST(total_price_usd AS DOUBLE) AS total_price_usd,
  CAST(CASE WHEN total_price_usd > 0 THEN 0 ELSE 1 END + CASE WHEN customer_id IS NOT NULL THEN 0 ELSE 2 END + CASE WHEN quantity > 0 THEN 0 ELSE 4 END
    + CASE WHEN discount_percent <= 50 THEN 0 ELSE 8 END AS BIGINT) AS broken_mask,
  CASE WHEN coalesce(total_price_usd > 0, FALSE) AND coalesce(quantity > 0, FALSE) THEN NULL ELSE concat_ws(',', CASE WHEN total_price_usd > 0 THEN NULL ELSE 'valid_total' END,
    CASE WHEN customer_id IS NOT NULL THEN NULL ELSE 'has_customer' END, CASE WHEN quantity > 0 THEN NULL ELSE 'valid_quantity' END,
    CASE WHEN discount_percent <= 50 THEN NULL ELSE 'small_discount' END) END AS quarantined_for FROM order_items_bronze""",
        "agg_daily_sales_refreshed": _BODIES["agg_daily_sales"],
        "bronze_mixed_headers": """
SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 3 <> 2 THEN city END AS city), CASE WHEN CAST(order_id AS BIGINT) % 3 = 2 THEN 'ch2' END AS channel,
  'incremental' AS load_type FROM orders_bronze""",
        "bronze_inferred_types": """
SELECT session_id, CAST(n % 1000 AS INT) AS hits, 'int' AS hits_type, CAST(n % 50 AS DOUBLE) + CAST(n % 7 AS DOUBLE) / 10 AS fee, 'decimal(3,1)' AS fee_type,
  CAST(n % 9 * 100 AS DOUBLE) AS ratio, 'double' AS ratio_type, CASE WHEN n % 2 = 1 THEN DATE '2024-01-01' + CAST(n % 90 AS INT) END AS seen, 'date' AS seen_type,
  '00' || CAST(n % 10 AS STRING) AS badge, 'string' AS badge_type FROM (SELECT session_id, CAST(session_id AS BIGINT) AS n FROM sessions_bronze)""",
        "bronze_type_widened": """
SELECT session_id, CAST(n % 1000 AS DOUBLE) + CASE WHEN n % 2 = 1 THEN 0.5 ELSE 0 END AS hits, 'decimal(4,1)' AS hits_type,
  CASE WHEN n % 2 = 1 THEN 'n/a ' ELSE '' END || CAST(n % 50 AS STRING) || '.' || CAST(n % 7 AS STRING) AS fee, 'string' AS fee_type
FROM (SELECT session_id, CAST(session_id AS BIGINT) AS n FROM sessions_bronze)""",
        "bronze_compacted": "SELECT * EXCLUDE (load_seq), 'incremental' AS load_type FROM risk_support_bronze",
        # Empty text does not survive a CSV file: it reads back as NULL.
        "scd1_stream": f"SELECT * REPLACE (nullif(payment_status, '') AS payment_status) FROM ({_BODIES['scd1_payments']})",
        "scd1_stream_one_batch": f"SELECT * REPLACE (nullif(payment_status, '') AS payment_status) FROM ({_BODIES['scd1_payments']})",
        "scd1_stream_late_backfill": f"SELECT * REPLACE (nullif(payment_status, '') AS payment_status) FROM ({_BODIES['scd1_payments']})",
        "scd1_equal_times": f"SELECT * REPLACE (nullif(payment_status, '') AS payment_status) FROM ({_BODIES['scd1_payments']})",
        "scd1_backfill_copied_later": f"""
SELECT product_id, CAST(unit_price_usd AS DOUBLE) AS unit_price_usd, CAST(unit_price_usd AS DOUBLE) AS version_price_usd
FROM products_bronze {_LATEST.format(key="product_id")}""",
        "scd2_incremental": _BODIES["scd2_risk_support"],
        "scd2_stream": f"SELECT product_id, unit_price_usd, __end_date IS NULL AS is_current FROM ({_PRODUCT_VERSIONS})",
        "bronze_rescued": """
SELECT order_id, product_id, CASE WHEN CAST(product_id AS BIGINT) % 4 >= 2 THEN rating END AS rating,
  CASE CAST(product_id AS BIGINT) % 4 WHEN 0 THEN '{"rating":"' || rating || '.5"}' WHEN 1 THEN '{"rating":"five"}' END AS rescued
FROM reviews_bronze""",
        "compacted_orders": "SELECT * FROM orders_bronze",
        "bronze_stream_700_files": "SELECT *, 'incremental' AS load_type FROM orders_bronze",
        "stored_daily_sales": _BODIES["agg_daily_sales"],
        "stored_lake": _BODIES["agg_customer_metrics"],
    }
)

ORACLE: dict[str, str] = {name: with_tables(body, {"wide_orders": _WIDE_ORDERS}) for name, body in _BODIES.items()}
ORACLE["agg_daily_sales_upserted"] = with_tables(_BODIES["agg_daily_sales"], _UPSERTED)

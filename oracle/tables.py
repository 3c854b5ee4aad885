"""Every table of the lake as a SQL common table expression."""

from __future__ import annotations

import re

from shoplake.sources.sample_views import SELECTS

_FROM = {
    "customers": "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "orders": "orders",
    "order_items": "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
    "products": "part CROSS JOIN (VALUES (0), (1)) x(v) WHERE v = 0 OR p_partkey % 10 = 0",
    "payments": "orders CROSS JOIN (VALUES (0), (1)) x(v) WHERE v = 0 OR o_orderkey % 10 = 0",
    "shipping": "orders CROSS JOIN (VALUES (0), (1)) x(v) WHERE v = 0 OR o_orderkey % 20 = 0",
    "reviews": "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "sessions": "events",
    "risk_support": "orders CROSS JOIN (VALUES (0), (1), (2)) x(v) "
    "WHERE v = 0 OR (v = 1 AND o_orderkey % 5 = 0) OR (v = 2 AND o_orderkey % 10 = 0)",
}


def avg2(x: str) -> str:
    return f"ROUND(CAST(CAST(SUM({x}) AS DOUBLE) / COUNT({x}) AS DECIMAL(28,8)), 2)"


def div2(a: str, b: str) -> str:
    return f"ROUND(CAST(CAST({a} AS DOUBLE) / NULLIF({b}, 0) AS DECIMAL(28,8)), 2)"


def pct(a: str, b: str) -> str:
    return div2(f"(({a}) * 100)", b)


AS_OF = "DATE '2002-01-01'"

TABLES: dict[str, str] = {
    **{f"{e}_bronze": f"SELECT {SELECTS[e]} FROM {_FROM[e]}" for e in SELECTS},
    "orders_silver": """
SELECT order_id || '_' || strftime(order_date, '%Y-%m-%d') AS order_key, order_id, customer_id, country, city, order_date,
  lower(trim(order_status)) AS order_status, lower(trim(order_priority)) AS order_priority, currency,
  CASE WHEN lower(trim(coupon_used)) = 'yes' THEN 1 ELSE 0 END AS coupon_used,
  CASE WHEN lower(trim(coupon_used)) = 'yes' THEN coupon_code END AS coupon_code,
  lower(trim(campaign_source)) AS campaign_source
FROM orders_bronze""",
    "customers_silver": """
SELECT customer_id, upper(left(trim(customer_name), 1)) || lower(substr(trim(customer_name), 2)) AS customer_name,
  CASE WHEN gender IS NULL THEN 'unknown' WHEN lower(trim(gender)) IN ('male', 'female') THEN lower(trim(gender)) ELSE 'other' END AS gender,
  age, lower(trim(customer_segment)) AS customer_segment, lower(trim(country)) AS country, lower(trim(city)) AS city,
  customer_loyalty_score, total_orders_by_customer, account_creation_date,
  CAST(year(account_creation_date) AS INTEGER) AS account_year, CAST(month(account_creation_date) AS INTEGER) AS account_month,
  CAST(day(account_creation_date) AS INTEGER) AS account_day
FROM customers_bronze
WHERE customer_id IS NOT NULL AND (age IS NULL OR (age >= 10 AND age <= 100))
  AND (customer_loyalty_score IS NULL OR (customer_loyalty_score >= 0 AND customer_loyalty_score <= 100))""",
    "order_items_silver": """
SELECT *, total_price_usd - coalesce(discount_amount_usd, 0) AS net_revenue_usd FROM (
  SELECT order_id, product_id, customer_id, CASE WHEN quantity <= 0 THEN NULL ELSE quantity END AS quantity,
    CASE WHEN unit_price_usd < 0 THEN NULL ELSE unit_price_usd END AS unit_price_usd,
    CASE WHEN discount_percent < 0 OR discount_percent > 100 THEN NULL ELSE CAST(discount_percent AS DOUBLE) END AS discount_percent,
    CASE WHEN discount_amount_usd < 0 THEN 0 ELSE discount_amount_usd END AS discount_amount_usd,
    CASE WHEN total_price_usd < 0 THEN NULL ELSE total_price_usd END AS total_price_usd,
    CASE WHEN tax_usd < 0 THEN 0 ELSE tax_usd END AS tax_usd, cost_usd, profit_usd,
    CAST(profit_margin_percent AS DOUBLE) AS profit_margin_percent
  FROM order_items_bronze)""",
    "products_silver": """
SELECT product_id, CASE WHEN unit_price_usd < 0 THEN NULL ELSE unit_price_usd END AS unit_price_usd,
  nullif(lower(trim(product_name)), '') AS product_name, nullif(lower(trim(category)), '') AS category,
  nullif(lower(trim(sub_category)), '') AS sub_category, nullif(lower(trim(brand)), '') AS brand,
  CASE WHEN product_rating_avg < 0 OR product_rating_avg > 5 THEN NULL ELSE product_rating_avg END AS product_rating_avg,
  CASE WHEN product_reviews_count < 0 THEN NULL ELSE product_reviews_count END AS product_reviews_count,
  CASE WHEN stock_quantity < 0 THEN NULL ELSE stock_quantity END AS stock_quantity
FROM products_bronze QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY load_seq DESC) = 1""",
    "payments_silver": """
SELECT order_id, customer_id, nullif(lower(trim(payment_method)), '') AS payment_method,
  nullif(lower(trim(payment_status)), '') AS payment_status, nullif(lower(trim(installment_plan)), '') AS installment_plan,
  CASE WHEN fraud_risk_score < 0 OR fraud_risk_score > 100 THEN NULL ELSE fraud_risk_score END AS fraud_risk_score,
  CASE WHEN total_price_usd < 0 THEN NULL ELSE total_price_usd END AS total_price_usd, nullif(lower(trim(currency)), '') AS currency
FROM payments_bronze QUALIFY row_number() OVER (PARTITION BY order_id, customer_id ORDER BY load_seq DESC) = 1""",
    "reviews_silver": """
SELECT order_id, product_id, customer_id, CASE WHEN rating < 1 OR rating > 5 THEN NULL ELSE rating END AS rating, sentiment,
  CASE WHEN sentiment = 'positive' THEN 1 ELSE 0 END AS is_positive, CASE WHEN sentiment = 'negative' THEN 1 ELSE 0 END AS is_negative,
  customer_feedback, order_date
FROM (SELECT *, CASE WHEN lower(trim(review_sentiment)) IN ('positive', 'negative', 'neutral') THEN lower(trim(review_sentiment))
        ELSE 'unknown' END AS sentiment FROM reviews_bronze)""",
    "risk_support_silver": """
SELECT order_id, customer_id, fraud_risk_score, CASE WHEN fraud_risk_score >= 70 THEN 1 ELSE 0 END AS is_high_risk,
  CASE WHEN order_status IN ('completed', 'pending', 'cancelled', 'returned', 'processing') THEN order_status ELSE 'other' END AS order_status,
  return_reason, CASE WHEN return_reason IS NOT NULL THEN 1 ELSE 0 END AS has_return, support_ticket_created,
  CASE WHEN support_ticket_created = 'yes' THEN 1 ELSE 0 END AS has_support_ticket
FROM (SELECT order_id, customer_id, CASE WHEN fraud_risk_score < 0 OR fraud_risk_score > 100 THEN NULL ELSE fraud_risk_score END AS fraud_risk_score,
        lower(trim(order_status)) AS order_status, lower(trim(return_reason)) AS return_reason,
        lower(trim(support_ticket_created)) AS support_ticket_created FROM risk_support_bronze)""",
    "sessions_silver": """
SELECT order_id, customer_id, device_type, CASE WHEN device_type = 'mobile' THEN 1 ELSE 0 END AS is_mobile, traffic_source, campaign_source,
  session_duration_minutes, pages_visited, abandoned_cart_before
FROM (SELECT order_id, customer_id,
        CASE WHEN lower(trim(device_type)) IN ('mobile', 'desktop', 'tablet') THEN lower(trim(device_type)) ELSE 'other' END AS device_type,
        lower(trim(traffic_source)) AS traffic_source, lower(trim(campaign_source)) AS campaign_source,
        CASE WHEN session_duration_minutes < 0 THEN NULL ELSE session_duration_minutes END AS session_duration_minutes,
        CASE WHEN pages_visited < 0 THEN 0 ELSE pages_visited END AS pages_visited, abandoned_cart_before FROM sessions_bronze)""",
    "shipping_silver": """
SELECT order_id, customer_id, lower(trim(shipping_method)) AS shipping_method,
  CASE WHEN shipping_cost_usd < 0 THEN NULL ELSE shipping_cost_usd END AS shipping_cost_usd,
  CASE WHEN delivery_days < 0 THEN NULL ELSE delivery_days END AS delivery_days, CASE WHEN delivery_days > 7 THEN 1 ELSE 0 END AS is_delayed,
  lower(trim(shipping_country)) AS shipping_country, lower(trim(warehouse_location)) AS warehouse_location,
  lower(trim(delivery_status)) AS delivery_status, load_seq
FROM shipping_bronze""",
    "dim_customers": f"""
SELECT customer_id, customer_name, gender, age,
  CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54'
       WHEN age < 65 THEN '55-64' ELSE '65+' END AS age_group, customer_segment, country, city, customer_loyalty_score,
  CASE WHEN customer_loyalty_score >= 80 THEN 'platinum' WHEN customer_loyalty_score >= 60 THEN 'gold'
       WHEN customer_loyalty_score >= 40 THEN 'silver' WHEN customer_loyalty_score >= 20 THEN 'bronze' ELSE 'basic' END AS loyalty_tier,
  total_orders_by_customer, account_creation_date,
  round(date_diff('day', account_creation_date, {AS_OF}) / 365.25::DOUBLE, 1) AS customer_tenure_years
FROM customers_silver""",
    "dim_products": """
SELECT product_id, product_name, category, sub_category, brand, unit_price_usd,
  CASE WHEN unit_price_usd < 20 THEN 'budget' WHEN unit_price_usd < 50 THEN 'economy' WHEN unit_price_usd < 100 THEN 'standard'
       WHEN unit_price_usd < 200 THEN 'premium' ELSE 'luxury' END AS price_tier, product_rating_avg,
  CASE WHEN product_rating_avg >= 4.5 THEN 'excellent' WHEN product_rating_avg >= 4.0 THEN 'very_good' WHEN product_rating_avg >= 3.5 THEN 'good'
       WHEN product_rating_avg >= 3.0 THEN 'average' WHEN product_rating_avg IS NOT NULL THEN 'below_average' ELSE 'not_rated' END AS rating_category,
  product_reviews_count, stock_quantity,
  CASE WHEN stock_quantity = 0 THEN 'out_of_stock' WHEN stock_quantity < 10 THEN 'low_stock' WHEN stock_quantity < 50 THEN 'in_stock'
       ELSE 'high_stock' END AS stock_status
FROM products_silver""",
    "dim_date": """
SELECT d AS date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  'Q' || quarter(d) AS quarter_name, year(d) || '-Q' || quarter(d) AS year_quarter, CAST(month(d) AS INTEGER) AS month,
  strftime(d, '%B') AS month_name, strftime(d, '%Y-%m') AS year_month, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
  CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, CASE WHEN dayofweek(d) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type,
  CAST(date_trunc('month', d) AS DATE) AS month_start_date, CAST(last_day(d) AS DATE) AS month_end_date
FROM (SELECT DISTINCT order_date AS d FROM orders_silver)""",
    "fact_orders": """
SELECT o.order_key, o.order_id, o.customer_id, o.order_date, o.country, o.city, o.order_status, o.order_priority, o.currency, o.coupon_used,
  o.coupon_code, o.campaign_source, i.total_items_quantity, i.total_line_items, i.unique_products_count, i.order_gross_amount,
  i.order_discount_amount, i.order_tax_amount, i.order_net_revenue, s.shipping_cost,
  coalesce(i.order_gross_amount, 0) + coalesce(s.shipping_cost, 0) AS total_order_value,
  pf.payment_method, pf.payment_status, p.payment_amount, pf.fraud_risk_score,
  CASE WHEN pf.fraud_risk_score >= 70 THEN 'high' WHEN pf.fraud_risk_score >= 40 THEN 'medium' WHEN pf.fraud_risk_score IS NOT NULL THEN 'low'
       ELSE 'unknown' END AS fraud_risk_category,
  sf.shipping_method, sf.delivery_status, sf.is_delayed
FROM orders_silver o
LEFT JOIN (SELECT order_id, CAST(sum(quantity) AS BIGINT) AS total_items_quantity, count(*) AS total_line_items,
             sum(total_price_usd) AS order_gross_amount, sum(discount_amount_usd) AS order_discount_amount, sum(tax_usd) AS order_tax_amount,
             sum(net_revenue_usd) AS order_net_revenue, count(DISTINCT product_id) AS unique_products_count
           FROM order_items_silver GROUP BY order_id) i ON o.order_id = i.order_id
LEFT JOIN (SELECT order_id, sum(total_price_usd) AS payment_amount FROM payments_silver GROUP BY order_id) p ON o.order_id = p.order_id
LEFT JOIN payments_silver pf ON o.order_id = pf.order_id
LEFT JOIN (SELECT order_id, sum(shipping_cost_usd) AS shipping_cost FROM shipping_silver GROUP BY order_id) s ON o.order_id = s.order_id
LEFT JOIN (SELECT * FROM shipping_silver QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY load_seq DESC) = 1) sf
  ON o.order_id = sf.order_id""",
    "fact_order_items": f"""
SELECT i.order_id, i.product_id, i.customer_id, o.order_date, o.country, o.city, i.quantity, i.unit_price_usd, i.discount_percent,
  i.discount_amount_usd,
  CASE WHEN i.total_price_usd > 0 THEN {pct("i.discount_amount_usd", "i.total_price_usd")} ELSE 0 END AS discount_percentage,
  i.total_price_usd, i.tax_usd, i.net_revenue_usd,
  CASE WHEN i.quantity > 0 THEN {div2("i.net_revenue_usd", "i.quantity")} ELSE 0 END AS revenue_per_unit,
  i.cost_usd, i.profit_usd, i.profit_margin_percent, o.order_status, CASE WHEN i.net_revenue_usd > 0 THEN 1 ELSE 0 END AS is_profitable_item
FROM order_items_silver i LEFT JOIN orders_silver o ON i.order_id = o.order_id""",
    "fact_sessions": """
SELECT *, CASE WHEN engagement_score >= 50 THEN 'high' WHEN engagement_score >= 20 THEN 'medium' ELSE 'low' END AS session_quality
FROM (SELECT order_id, customer_id, session_duration_minutes, pages_visited,
        round(session_duration_minutes * 2 + pages_visited * 5, 2) AS engagement_score,
        device_type, is_mobile, traffic_source, campaign_source, abandoned_cart_before FROM sessions_silver)""",
    "fact_reviews": f"""
SELECT order_id, product_id, customer_id, order_date, rating,
  CASE rating WHEN 5 THEN 'excellent' WHEN 4 THEN 'good' WHEN 3 THEN 'average' WHEN 2 THEN 'poor' WHEN 1 THEN 'very_poor' ELSE 'not_rated' END
    AS rating_category,
  sentiment, is_positive, is_negative, customer_feedback, CAST(date_diff('day', order_date, {AS_OF}) AS INTEGER) AS days_since_review,
  CASE WHEN (rating >= 4 AND sentiment = 'positive') OR (rating = 3 AND sentiment = 'neutral') OR (rating <= 2 AND sentiment = 'negative')
       THEN 1 ELSE 0 END AS sentiment_rating_aligned
FROM reviews_silver""",
    "fact_shipping": f"""
SELECT s.order_id, s.customer_id, o.order_date, o.country, o.city, s.shipping_method, s.shipping_country, s.warehouse_location, s.shipping_cost_usd,
  CASE WHEN s.delivery_days > 0 THEN {div2("s.shipping_cost_usd", "s.delivery_days")} ELSE s.shipping_cost_usd END AS shipping_cost_per_day,
  s.delivery_days, CASE WHEN s.delivery_days <= 2 THEN 'express' WHEN s.delivery_days <= 5 THEN 'fast' WHEN s.delivery_days <= 10 THEN 'standard'
       ELSE 'slow' END AS delivery_speed, s.delivery_status, s.is_delayed
FROM shipping_silver s LEFT JOIN orders_silver o ON s.order_id = o.order_id""",
    "agg_daily_sales": f"""
SELECT order_date, count(order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers, sum(order_gross_amount) AS gross_revenue,
  sum(order_discount_amount) AS total_discounts, sum(order_net_revenue) AS net_revenue, sum(shipping_cost) AS total_shipping_revenue,
  sum(total_order_value) AS total_revenue, {avg2("total_order_value")} AS avg_order_value, {avg2("order_net_revenue")} AS avg_net_revenue,
  CAST(sum(total_items_quantity) AS BIGINT) AS total_items_sold, CAST(sum(total_line_items) AS BIGINT) AS total_line_items,
  {avg2("total_line_items")} AS avg_items_per_order, count(*) FILTER (order_status = 'completed') AS completed_orders,
  count(*) FILTER (order_status = 'cancelled') AS cancelled_orders, count(*) FILTER (order_status = 'pending') AS pending_orders,
  CAST(sum(is_delayed) AS BIGINT) AS delayed_deliveries, count(*) FILTER (payment_status = 'completed') AS successful_payments,
  count(*) FILTER (payment_status = 'failed') AS failed_payments, {avg2("fraud_risk_score")} AS avg_fraud_risk_score,
  {pct("count(*) FILTER (order_status = 'completed')", "count(order_id)")} AS completion_rate,
  {pct("count(*) FILTER (order_status = 'cancelled')", "count(order_id)")} AS cancellation_rate,
  {pct("count(order_id) - sum(is_delayed)", "count(order_id)")} AS on_time_delivery_rate
FROM fact_orders GROUP BY order_date""",
    "agg_customer_metrics": f"""
SELECT c.*, o.* EXCLUDE (customer_id), s.* EXCLUDE (customer_id), r.* EXCLUDE (customer_id),
  CAST(date_diff('day', o.first_order_date, {AS_OF}) AS INTEGER) AS days_since_first_order,
  CAST(date_diff('day', o.last_order_date, {AS_OF}) AS INTEGER) AS days_since_last_order,
  CASE WHEN date_diff('day', o.last_order_date, {AS_OF}) <= 30 THEN 'active' WHEN date_diff('day', o.last_order_date, {AS_OF}) <= 90 THEN 'at_risk'
       WHEN date_diff('day', o.last_order_date, {AS_OF}) <= 180 THEN 'dormant' ELSE 'churned' END AS customer_recency_segment,
  CASE WHEN o.lifetime_value >= 1000 THEN 'high_value' WHEN o.lifetime_value >= 500 THEN 'medium_value' ELSE 'low_value' END
    AS customer_value_segment
FROM dim_customers c
LEFT JOIN (SELECT customer_id, count(order_id) AS total_orders, sum(total_order_value) AS lifetime_value, sum(order_net_revenue) AS lifetime_net_revenue,
             {avg2("total_order_value")} AS avg_order_value, {avg2("order_net_revenue")} AS avg_net_revenue, min(order_date) AS first_order_date,
             max(order_date) AS last_order_date, CAST(sum(total_items_quantity) AS BIGINT) AS total_items_purchased,
             count(DISTINCT country) AS countries_shopped_from, count(*) FILTER (order_status = 'completed') AS completed_orders,
             count(*) FILTER (order_status = 'cancelled') AS cancelled_orders
           FROM fact_orders GROUP BY customer_id) o ON c.customer_id = o.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS total_sessions, CAST(sum(pages_visited) AS BIGINT) AS total_pages_visited,
             {avg2("engagement_score")} AS avg_engagement_score FROM fact_sessions GROUP BY customer_id) s ON c.customer_id = s.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS total_reviews, {avg2("rating")} AS avg_rating_given FROM fact_reviews GROUP BY customer_id) r
  ON c.customer_id = r.customer_id""",
    "agg_product_performance": f"""
SELECT p.*, f.* EXCLUDE (product_id), r.* EXCLUDE (product_id),
  CASE WHEN f.total_quantity_sold > 0 THEN {div2("f.total_revenue", "f.total_quantity_sold")} ELSE 0 END AS revenue_per_unit,
  CASE WHEN r.review_count > 0 THEN {pct("r.positive_reviews", "r.review_count")} ELSE 0 END AS positive_review_rate,
  round(coalesce(r.avg_rating, 3) * 10 + CAST(f.total_quantity_sold AS DECIMAL(18,1)) / 10, 2) AS product_performance_score,
  CASE WHEN f.total_quantity_sold >= 100 THEN 'fast_moving' WHEN f.total_quantity_sold >= 50 THEN 'moderate'
       WHEN f.total_quantity_sold >= 10 THEN 'slow_moving' ELSE 'stagnant' END AS inventory_turnover_category
FROM dim_products p
LEFT JOIN (SELECT product_id, count(*) AS total_units_sold, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, sum(net_revenue_usd) AS total_revenue,
             sum(discount_amount_usd) AS total_discounts_given, {avg2("unit_price_usd")} AS avg_selling_price,
             {avg2("discount_percentage")} AS avg_discount_percentage, count(DISTINCT customer_id) AS unique_customers,
             count(DISTINCT order_id) AS unique_orders FROM fact_order_items GROUP BY product_id) f ON p.product_id = f.product_id
LEFT JOIN (SELECT product_id, count(*) AS review_count, {avg2("rating")} AS avg_rating, CAST(sum(is_positive) AS BIGINT) AS positive_reviews,
             CAST(sum(is_negative) AS BIGINT) AS negative_reviews FROM fact_reviews GROUP BY product_id) r ON p.product_id = r.product_id""",
}


def with_tables(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with the expressions it needs, in order."""
    known = {**TABLES, **(extra or {})}
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in known:
            if name not in ordered and re.search(rf"\b{name}\b", sql):
                if known[name] is not sql:
                    need(known[name])
                    if name not in ordered:
                        ordered.append(name)

    need(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in ordered) + "\n" + body


def as_doubles(*columns: str) -> str:
    """Star projection with the named decimal columns as doubles."""
    return "* REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns) + ")" if columns else "*"

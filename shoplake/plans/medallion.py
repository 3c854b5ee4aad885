"""The table list of the lake and how each table follows from others."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from shoplake.config import ENTITIES, HISTORY, KEYS, LOAD_PATTERN, UPSERT
from shoplake.functions.shape import conform
from shoplake.operators.dedup import keep_latest_known
from shoplake.operators.history import scd2
from shoplake.plans import aggregates, dimensions, facts, silver


@dataclass(frozen=True)
class Table:
    make: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    # Takes the date that relative columns count to.
    dated: bool = False
    # Can make use of inputs that are bucketed by order.
    by_order: bool = False


def versions(entity: str) -> Callable[[DataFrame], DataFrame]:
    """Builder of an entity's version history, from everything that was ever landed for it."""
    return lambda bronze: scd2(conform(bronze, entity), KEYS[entity])


# In build order: a table comes after its inputs.
TABLES: dict[str, Table] = {
    **{f"{e}_silver": Table(getattr(silver, e), (f"{e}_bronze",)) for e in ENTITIES},
    **{f"{e}_history": Table(versions(e), (f"{e}_bronze",)) for e in ENTITIES if LOAD_PATTERN[e] == HISTORY},
    "dim_customers": Table(dimensions.dim_customers, ("customers_silver",), dated=True),
    "dim_products": Table(dimensions.dim_products, ("products_silver",)),
    "dim_date": Table(dimensions.dim_date, ("orders_silver",)),
    "fact_orders": Table(
        facts.fact_orders, ("orders_silver", "order_items_silver", "payments_silver", "shipping_silver"), by_order=True
    ),
    "fact_order_items": Table(facts.fact_order_items, ("order_items_silver", "orders_silver"), by_order=True),
    "fact_sessions": Table(facts.fact_sessions, ("sessions_silver",)),
    "fact_reviews": Table(facts.fact_reviews, ("reviews_silver",), dated=True),
    "fact_shipping": Table(facts.fact_shipping, ("shipping_silver", "orders_silver"), by_order=True),
    "agg_daily_sales": Table(aggregates.agg_daily_sales, ("fact_orders",)),
    "agg_customer_metrics": Table(
        aggregates.agg_customer_metrics, ("dim_customers", "fact_orders", "fact_sessions", "fact_reviews"), dated=True
    ),
    "agg_product_performance": Table(
        aggregates.agg_product_performance, ("dim_products", "fact_order_items", "fact_reviews")
    ),
}


# Stored in buckets of equal order ids when asked for.
BUCKETED = ("orders_silver", "order_items_silver", "payments_silver", "shipping_silver")


def make(name: str, inputs: list[DataFrame], as_of: dt.date | None = None, laid_out: bool = False) -> DataFrame:
    table = TABLES[name]
    options = {"as_of": as_of or dt.date.today()} if table.dated else {}
    if table.by_order:
        options["laid_out"] = laid_out
    return table.make(*inputs, **options)


def upserted(entity: str, bronze: DataFrame) -> DataFrame:
    """Bronze rows reduced to the newest per business key, for entities whose files carry corrections.

    Only rows with a complete key can be matched; others are kept as they are.
    """
    keys = KEYS[entity]
    if LOAD_PATTERN[entity] != UPSERT or not set(keys) <= set(bronze.columns):
        return bronze
    return keep_latest_known(bronze, keys)


def build(
    name: str,
    bronze: Callable[[str], DataFrame],
    as_of: dt.date | None = None,
    upsert: bool = False,
    made: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """A table as one plan over its bronze inputs; ``bronze(entity)`` reads an entity.

    ``upsert`` applies corrections of orders, payments and shipments before cleaning, so that a re-sent
    record counts once.
    """
    made = {} if made is None else made
    if name not in made:
        if name.endswith("_bronze"):
            entity = name.removesuffix("_bronze")
            made[name] = upserted(entity, bronze(entity)) if upsert else bronze(entity)
        else:
            made[name] = make(name, [build(i, bronze, as_of, upsert, made) for i in TABLES[name].inputs], as_of)
    return made[name]

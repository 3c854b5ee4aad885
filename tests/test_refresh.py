"""Tables kept up by change, and expectations that act."""

import datetime as dt
import os
import random
import shutil

import pytest
from conftest import SF, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_flows import ids, put

from __spark_entry__ import Sample
from shoplake.config import staging_path
from shoplake.functions.shape import publish
from shoplake.operators import quality
from shoplake.plans import refresh
from shoplake.plans.aggregates import agg_daily_sales
from shoplake.session import scratch_made
from shoplake.streaming import checked, flows


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


# --- daily sales by change -----------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def facts(spark):
    return publish(Sample(spark, SF)["fact_orders"]).cache()


def typed(spark, facts, seed):
    """A version of the facts: some rows left out, some twice, some with another day, customer or state, some without a day."""
    draw = F.pmod(F.xxhash64("order_id", F.lit(seed)), F.lit(20))
    moved = F.when(draw == 3, F.date_add("order_date", seed)).when(draw == 4, F.lit(None)).otherwise(F.col("order_date"))
    changed = facts.filter(draw > 2).withColumns(
        {
            "order_date": moved,
            "customer_id": F.when(draw == 5, F.lit(f"c{seed}")).when(draw == 6, F.lit(None)).otherwise(F.col("customer_id")),
            "fraud_risk_score": F.when(draw == 7, F.lit(0.1) * seed).otherwise(F.col("fraud_risk_score")),
            "payment_status": F.when(draw == 8, F.lit("failed")).otherwise(F.col("payment_status")),
            **{c: F.col(c).cast("decimal(18,4)") for c in ("order_gross_amount", "order_discount_amount", "order_net_revenue", "shipping_cost", "total_order_value")},
        }
    )
    return changed.unionByName(changed.filter(draw == 9))


def test_refreshed_sales_are_those_of_a_rebuild(spark, lake, facts):
    for version, seed in enumerate((1, 2, 2, 5)):
        lake._store("fact_orders", typed(spark, facts, seed), 0)
        assert refresh.refresh_daily_sales(lake)
        assert not refresh.refresh_daily_sales(lake)
        assert refresh.refreshed_version(lake) == version
        made = refresh.refreshed_daily_sales(lake)
        whole = agg_daily_sales(lake.table("fact_orders"))
        assert rows(publish(made)) == rows(publish(whole))
    # The third version equals the second, so nothing was written for it.
    days = spark.read.parquet(lake.path("daily_states", "days"))
    assert {r.generation for r in days.select("generation").distinct().collect()} == {0, 1, 3}


def test_only_changed_days_are_written(spark, lake, facts):
    lake._store("fact_orders", facts, 0)
    refresh.refresh_daily_sales(lake)
    day = facts.agg(F.min("order_date")).first()[0]
    later = F.col("order_date") == F.lit(day)
    lake._store("fact_orders", facts.withColumn("order_status", F.when(later, F.lit("lost")).otherwise(F.col("order_status"))), 0)
    refresh.refresh_daily_sales(lake)
    last = spark.read.parquet(lake.path("daily_states", "days")).filter("generation = 1")
    assert [r.order_date for r in last.collect()] == [day]


def test_versions_meet_once(spark, lake, facts, monkeypatch):
    """The first version is not compared with an empty one; later differences are worked out once for both states, and not kept."""
    calls, seen, plain, days = [], [], refresh.signed_changes, refresh.day_states
    monkeypatch.setattr(refresh, "signed_changes", lambda old, new: calls.append(1) or plain(old, new))
    monkeypatch.setattr(refresh, "day_states", lambda changes: seen.append(changes._jdf.queryExecution().executedPlan().toString()) or days(changes))
    held = scratch_made(spark)
    for version, seed in enumerate((1, 2)):
        lake._store("fact_orders", typed(spark, facts, seed), 0)
        refresh.refresh_daily_sales(lake)
        assert len(calls) == version and not any("Union" in p or "Aggregate" in p for p in seen)
    assert len(seen) == 2 and scratch_made(spark) == held
    assert rows(publish(refresh.refreshed_daily_sales(lake))) == rows(publish(agg_daily_sales(lake.table("fact_orders"))))


def test_months_from_daily_states(spark, lake, facts):
    for seed in (1, 4):
        lake._store("fact_orders", typed(spark, facts, seed), 0)
        refresh.refresh_daily_sales(lake)
    found = refresh.monthly_customers(refresh._states(lake, "customers"))
    direct = lake.table("fact_orders").groupBy(F.trunc("order_date", "month").alias("month")).agg(F.count_distinct("customer_id").alias("unique_customers"))
    assert rows(found) == rows(direct.filter("unique_customers > 0"))


def test_an_interrupted_refresh_does_not_count(spark, lake, facts):
    lake._store("fact_orders", facts, 0)
    refresh.refresh_daily_sales(lake)
    expected = rows(refresh.refreshed_daily_sales(lake))
    spark.read.parquet(lake.path("daily_states", "days", "generation=0")).write.parquet(lake.path("daily_states", "days", "generation=1"))
    assert rows(refresh.refreshed_daily_sales(lake)) == expected


def test_bags_may_hold_a_row_many_times(spark):
    draw = random.Random(1)
    old, new = ([(draw.choice("ab"), draw.choice([None, 1, 2])) for _ in range(n)] for n in (50, 70))
    found = refresh.signed_changes(*(spark.createDataFrame(x, "k string, v int") for x in (old, new)))
    expected = {x: new.count(x) - old.count(x) for x in {*old, *new}}
    assert {(r.k, r.v): r._sign for r in found.collect()} == {x: n for x, n in expected.items() if n}
    assert refresh.signed_changes(*(spark.createDataFrame(old, "k string, v int") for _ in range(2))).count() == 0


# --- expectations ---------------------------------------------------------------------------------------------------------
RULES = {"has_city": ("city IS NOT NULL", "drop"), "short": ("length(city) < 9", "warn"), "has_order": ("order_id IS NOT NULL", "fail")}


def lose_last_commit(lake, *stream):
    commits = lake.path("checkpoints", *stream, "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))


def test_rows_that_break_a_rule_are_kept_apart(spark, lake, landing):
    folder = staging_path(landing, "orders")
    put(folder, "a.csv", "order_id,city\nO1,here\nO2,\nO3,a long name of a city\n")
    flows.ingest(lake, landing, ["orders"])
    checked.check_stream(lake, "orders", RULES)
    put(folder, "b.csv", "order_id,city,note\nO4,there,n\nO5,,m\n")
    flows.ingest(lake, landing, ["orders"])
    checked.check_stream(lake, "orders", RULES)

    def state():
        held = checked.quarantine(lake, "orders", RULES)
        return (
            sorted((r.order_id, r._broken) for r in checked.clean_rows(lake, "orders").collect()),
            sorted((r.order_id, r._broken, tuple(r.broken_rules), r.note) for r in held.collect()),
            sorted((r.batch_id, r.expectation, r.action, r.total_rows, r.failed_rows) for r in checked.expectation_counts(lake, "orders").collect()),
        )

    before = state()
    # A missing city has no known length either.
    both = ("has_city", "short")
    assert before[0] == [("O1", 0), ("O3", checked.mask_of(RULES, ["short"])), ("O4", 0)]
    assert before[1] == [("O2", 3, both, None), ("O5", 3, both, "m")]
    assert before[2] == [
        (0, "has_city", "drop", 3, 1), (0, "has_order", "fail", 3, 0), (0, "short", "warn", 3, 2),
        (1, "has_city", "drop", 2, 1), (1, "has_order", "fail", 2, 0), (1, "short", "warn", 2, 1),
    ]
    lose_last_commit(lake, "orders", "checked")
    checked.check_stream(lake, "orders", RULES)
    assert state() == before


def test_a_failing_batch_leaves_no_rows(spark, lake, landing):
    folder = staging_path(landing, "orders")
    put(folder, "a.csv", "order_id,city\nO1,here\n")
    flows.ingest(lake, landing, ["orders"])
    checked.check_stream(lake, "orders", RULES)
    put(folder, "b.csv", "order_id,city\nO2,here\n,there\n")
    flows.ingest(lake, landing, ["orders"])
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="has_order: 1 rows"):
            checked.check_stream(lake, "orders", RULES)
        assert [r.order_id for r in checked.clean_rows(lake, "orders").collect()] == ["O1"]
    # Once the rule only warns, the batch goes through.
    checked.check_stream(lake, "orders", {**RULES, "has_order": ("order_id IS NOT NULL", "warn")})
    assert checked.clean_rows(lake, "orders").count() == 3


def test_nothing_to_check(spark, lake):
    checked.check_stream(lake, "orders", RULES)
    assert checked.clean_rows(lake, "orders").count() == checked.quarantine(lake, "orders", RULES).count() == 0
    with pytest.raises(ValueError, match="unknown actions"):
        checked.check_stream(lake, "orders", {"x": ("TRUE", "ignore")})


def test_masks_of_rules(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (5, "y")], "a int, b string")
    rules = {"a_small": "a < 3", "b_there": "b IS NOT NULL"}
    assert [r.m for r in df.select(quality.broken_mask(rules).alias("m")).collect()] == [2, 1, 1]


def test_rules_act_while_a_table_is_stored(spark, lake, landing):
    put(staging_path(landing, "orders"), "a.csv", "order_id,customer_id,order_date\nO1,C1,2024-01-01\nO2,,2024-01-01\n,C3,2024-01-02\n")
    flows.ingest(lake, landing, ["orders"])
    rules = {"has_customer": ("customer_id IS NOT NULL", "drop"), "has_order": "order_id IS NOT NULL"}
    counts = lake.materialize(["orders_silver"], dt.date(2024, 6, 1), expectations={"orders_silver": rules})
    assert counts == {"orders_silver": {"_rows": 3, "has_customer": 1, "has_order": 1}}
    assert sorted(r.customer_id for r in lake.table("orders_silver").collect()) == ["C1", "C3"]
    with pytest.raises(Exception, match="expectation has_order failed"):
        lake.materialize(["orders_silver"], expectations={"orders_silver": {"has_order": ("order_id IS NOT NULL", "fail")}})
    assert lake.version("orders_silver") == 0 and lake.table("orders_silver").count() == 2
    lake.materialize(["orders_silver"])
    assert ids(lake.table("orders_silver").fillna("", "order_id")) == ["", "O1", "O2"]
    shutil.rmtree(lake.path("tables"))

"""Landing, streaming, replay and storage."""

import datetime as dt
import json
import os
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shoplake.config import ENTITIES, INCREMENTAL, KEYS, METADATA, full_load_path, staging_path
from shoplake.operators.dedup import keep_latest
from shoplake.operators.history import END, START, scd2
from shoplake.plans import silver
from shoplake.plans.facts import fact_reviews
from shoplake.plans.medallion import upserted
from shoplake.sources import csv
from shoplake.sources.lake import Lake, compact
from shoplake.streaming import flows


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


@pytest.fixture
def full(tmp_path):
    return str(tmp_path / "full")


def ids(df):
    return sorted(r[0] for r in df.select("order_id").collect())


def test_each_file_is_taken_once(spark, lake, landing):
    folder = staging_path(landing, "orders")
    put(folder, "a.csv", "order_id,order_date\nO1,2024-01-01\n")
    put(folder, "b.csv", "order_id,order_date\nO2,2024-01-02\n")
    flows.ingest(lake, landing)
    assert ids(lake.bronze("orders")) == ["O1", "O2"]
    put(folder, "c.csv", "order_id,order_date\nO3,bad\n")
    flows.ingest(lake, landing)
    flows.ingest(lake, landing)
    assert ids(lake.bronze("orders")) == ["O1", "O2", "O3"]
    landed = lake.bronze("orders").orderBy("order_id").collect()
    assert [r.order_date for r in landed] == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]
    assert {r._load_type for r in landed} == {"incremental"}
    assert landed[0]._source_file.endswith("a.csv") and landed[0]._ingestion_timestamp is not None


def test_a_repeated_batch_replaces_itself(spark, lake, landing):
    """Losing the commit of the last batch makes the stream run it again."""
    folder = staging_path(landing, "orders")
    put(folder, "a.csv", "order_id\nO1\n")
    flows.ingest(lake, landing, ["orders"])
    put(folder, "b.csv", "order_id\nO2\n")
    flows._finish([flows.start_staging(lake, "orders", landing)])
    commits = lake.path("checkpoints", "orders", "staging", "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    flows.ingest(lake, landing, ["orders"])
    assert ids(lake.bronze("orders")) == ["O1", "O2"]


def test_columns_bind_by_name(spark, lake, landing):
    folder = staging_path(landing, "shipping")
    put(folder, "a.csv", "order_id,delivery_days,shipping_cost_usd\nO1,3,1.5\n")
    put(folder, "b.csv", "shipping_cost_usd,carrier,order_id\n2.25,fast co,O2\n")
    flows.ingest(lake, landing, ["shipping"])
    found = {r.order_id: r for r in lake.bronze("shipping").collect()}
    assert (found["O1"].delivery_days, float(found["O1"].shipping_cost_usd), found["O1"].carrier) == (3, 1.5, None)
    assert (found["O2"].delivery_days, float(found["O2"].shipping_cost_usd), found["O2"].carrier) == (None, 2.25, "fast co")


def test_column_names_ignore_case(spark, lake, landing):
    put(staging_path(landing, "orders"), "a.csv", "Order_ID,CITY,Note\nO1,here,n\n")
    flows.ingest(lake, landing, ["orders"])
    row = lake.bronze("orders").first()
    assert (row.order_id, row.city, row.Note) == ("O1", "here", "n")


def test_a_column_may_appear_later(spark, lake, landing):
    folder = staging_path(landing, "orders")
    put(folder, "a.csv", "order_id\nO1\n")
    flows.ingest(lake, landing, ["orders"])
    put(folder, "b.csv", "order_id,channel\nO2,app\n")
    flows.ingest(lake, landing, ["orders"])
    assert sorted((r.order_id, r.channel) for r in lake.bronze("orders").collect()) == [("O1", None), ("O2", "app")]


@pytest.mark.parametrize("odd_one", [False, True])
def test_many_files(spark, lake, landing, odd_one):
    folder = staging_path(landing, "orders")
    for i in range(20):
        put(folder, f"{i:03}.csv", f"order_id,city\nO{i:03},here\n")
    if odd_one:
        put(folder, "zzz.csv", "city,order_id\nthere,O999\n")
    flows.ingest(lake, landing, ["orders"])
    found = lake.bronze("orders")
    assert found.count() == 20 + odd_one
    assert found.filter("city = 'here' AND order_id LIKE 'O%'").count() == 20
    assert found.filter("city = 'there' AND order_id = 'O999'").count() == int(odd_one)


def test_files_per_batch(spark, lake, landing):
    folder = staging_path(landing, "orders")
    for i in range(5):
        put(folder, f"{i}.csv", f"order_id\nO{i}\n")
    flows.ingest(lake, landing, ["orders"], files_per_batch=2)
    assert ids(lake.bronze("orders")) == [f"O{i}" for i in range(5)]
    assert len([d for d in os.listdir(lake.path("staging", "orders")) if d.startswith("batch_id=")]) == 3


def test_nothing_arrived(spark, lake, landing):
    os.makedirs(staging_path(landing, "orders"))
    flows.ingest(lake, landing)
    flows.upsert(lake, "orders")
    assert lake.bronze("orders").count() == 0
    assert flows.current(lake, "orders").count() == 0
    assert lake.bronze("orders").columns[-len(METADATA) :] == list(METADATA)


def test_header_only_and_empty_files(spark, lake, landing):
    folder = staging_path(landing, "orders")
    put(folder, "a.csv", "order_id\n")
    put(folder, "b.csv", "")
    put(folder, "c.csv", "order_id\nO1\n")
    flows.ingest(lake, landing, ["orders"])
    assert ids(lake.bronze("orders")) == ["O1"]


def test_backfill_runs_once_and_keeps_its_rows_beside_the_stream(spark, lake, landing, full):
    put(full, "orders.csv", "order_id\nO1\nO2\n")
    assert lake.backfill("orders", full)
    put(staging_path(landing, "orders"), "a.csv", "order_id\nO3\n")
    flows.ingest(lake, landing, ["orders"])
    assert not lake.backfill("orders", full)
    assert ids(lake.bronze("orders")) == ["O1", "O2", "O3"]
    kinds = {r.order_id: r._load_type for r in lake.bronze("orders").collect()}
    assert kinds == {"O1": "full_load", "O2": "full_load", "O3": "incremental"}
    assert not lake.backfill("customers", full)


def test_interrupted_backfill_starts_over(spark, lake, full):
    put(full, "orders.csv", "order_id\nO1\nO2\n")
    lake.backfill("orders", full)
    shutil.rmtree(lake.path("bronze", "orders", "full_loaded"))
    assert lake.backfill("orders", full)
    assert ids(lake.bronze("orders")) == ["O1", "O2"]


def test_all_entities_flow(spark, lake, landing, full):
    """The same loop serves every entity."""
    for entity in ENTITIES:
        key = KEYS[entity][0]
        put(full, f"{entity}.csv", f"{key}\nK1\n")
        lake.backfill(entity, full)
        if entity in INCREMENTAL:
            put(staging_path(landing, entity), "a.csv", f"{key}\nK2\n")
    flows.ingest(lake, landing)
    for entity in ENTITIES:
        expected = ["K1", "K2"] if entity in INCREMENTAL else ["K1"]
        assert sorted(r[0] for r in lake.bronze(entity).select(KEYS[entity][0]).collect()) == expected
    rules = {"orders_silver": {"has_customer": "customer_id IS NOT NULL", "has_order": "order_id IS NOT NULL"}}
    counts = lake.materialize(as_of=dt.date(2024, 6, 1), expectations=rules)
    assert counts == {"orders_silver": {"_rows": 2, "has_customer": 2, "has_order": 0}}
    assert lake.table("products_history").count() == 2
    assert lake.table("agg_customer_metrics").count() == 1
    assert lake.table("agg_product_performance").count() == 2
    assert lake.table("fact_orders").count() == 2
    assert lake.table("agg_daily_sales").first().total_orders == 2


def test_incremental_rows_beat_the_backfill(spark, lake, landing, full):
    put(full, "products.csv", "product_id,brand\nP1,old\n")
    lake.backfill("products", full)
    put(staging_path(landing, "products"), "a.csv", "product_id,brand\nP1,new\n")
    flows.ingest(lake, landing, ["products"])
    lake.materialize(["products_silver"])
    assert [r.brand for r in lake.table("products_silver").collect()] == ["new"]


def test_upsert_flow(spark, lake, landing, full):
    put(full, "orders.csv", "order_id,city\nO1,a\nO2,a\n")
    lake.backfill("orders", full)

    def state():
        return {r.order_id: r.city for r in flows.current(lake, "orders").collect()}

    assert state() == {"O1": "a", "O2": "a"}
    put(staging_path(landing, "orders"), "a.csv", "order_id,city\nO2,b\nO3,b\n")
    flows.ingest(lake, landing, ["orders"])
    flows.upsert(lake, "orders")
    assert state() == {"O1": "a", "O2": "b", "O3": "b"}
    flows.compact_current(lake, "orders")
    assert state() == {"O1": "a", "O2": "b", "O3": "b"}
    put(staging_path(landing, "orders"), "b.csv", "order_id,city\nO3,c\n")
    flows.ingest(lake, landing, ["orders"])
    flows.upsert(lake, "orders")
    flows.upsert(lake, "orders")
    assert state() == {"O1": "a", "O2": "b", "O3": "c"}
    flows.compact_current(lake, "orders")
    flows.compact_current(lake, "orders")
    assert state() == {"O1": "a", "O2": "b", "O3": "c"}


def test_upsert_option_counts_a_resent_order_once(spark, lake, landing, full):
    put(full, "orders.csv", "order_id,order_date,order_status\nO1,2024-01-01,pending\n")
    lake.backfill("orders", full)
    put(staging_path(landing, "orders"), "a.csv", "order_id,order_date,order_status\nO1,2024-01-01,completed\n")
    flows.ingest(lake, landing, ["orders"])
    for upsert, total, done in ((False, 2, 1), (True, 1, 1)):
        silver = [f"{e}_silver" for e in ("orders", "order_items", "payments", "shipping")]
        lake.materialize([*silver, "fact_orders", "agg_daily_sales"], upsert=upsert)
        day = lake.table("agg_daily_sales").first()
        assert (day.total_orders, day.completed_orders) == (total, done)


def test_inferred_schema(spark, full):
    put(full, "x.csv", "a,b,c,d\n1,1.5,2024-01-02,x\n2,2.5,2024-01-03,y\n")
    schema = csv.infer_schema(spark, f"{full}/x.csv", 1.0)
    assert [f.dataType.simpleString() for f in schema] == ["int", "double", "date", "string"]


def test_compaction(spark, tmp_path):
    source, target = str(tmp_path / "small"), str(tmp_path / "even")
    spark.range(1000).select("id", (F.col("id") % 3).alias("g")).repartition(20).write.parquet(source)
    compact(spark, source, target, "g")
    assert rows(spark.read.parquet(target)) == rows(spark.read.parquet(source))
    assert len([f for f in os.listdir(target) if f.endswith(".parquet")]) < 20


def test_lake_over_missing_root(spark, tmp_path):
    assert Lake(spark, str(tmp_path / "nowhere")).bronze("orders").count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, full):
    from conftest import SF

    from shoplake.functions.shape import conform, publish
    from shoplake.operators import skew
    from shoplake.plans.medallion import BUCKETED, make
    from shoplake.sources.sample_views import bronze_entity, reader

    read = reader(spark, SF)
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    lake = Lake(spark, str(tmp_path / "lake"), "shop")
    for entity in ("orders", "order_items", "payments", "shipping"):
        conform(bronze_entity(read, entity), entity).write.parquet(lake.path("bronze", entity, "full"))
    facts = ("fact_orders", "fact_order_items", "fact_shipping")
    lake.materialize([*BUCKETED, *facts])
    plain = {name: rows(publish(lake.table(name))) for name in facts}

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lake.materialize([*BUCKETED, *facts], buckets=4)
        for name, inputs in (
            ("fact_orders", BUCKETED),
            ("fact_order_items", ("order_items_silver", "orders_silver")),
            ("fact_shipping", ("shipping_silver", "orders_silver")),
        ):
            assert rows(publish(lake.table(name))) == plain[name]
            made = make(name, [lake.table(i) for i in inputs], laid_out=True)
            assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
        # With any repeated order id counted as heavy, the lines stay out of buckets and their old entry is dropped.
        spark.conf.set(skew.MIN_ROWS, "0")
        spark.conf.set(skew.SHARE, "0")
        lake.materialize([*BUCKETED, *facts], buckets=4)
        assert not spark.catalog.tableExists("shop.order_items_silver")
        assert spark.catalog.tableExists("shop.orders_silver")
        for name in facts:
            assert rows(publish(lake.table(name))) == plain[name]
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", skew.MIN_ROWS, skew.SHARE):
            spark.conf.unset(name)


def test_scratch_folders(spark):
    from shoplake.session import scratch_dir

    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(shared) and two.startswith(shared)


def test_scratch_folder_without_a_configured_one():
    from types import SimpleNamespace

    from shoplake.session import scratch_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, applicationId="app", master="local[2]")
    bare = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    one, two = scratch_dir(bare, "x"), scratch_dir(bare, "x")
    assert one != two and os.path.dirname(one) == os.path.dirname(two)
    context.master = "spark://host:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(bare, "x")


def write_at(folder, name, text, seconds):
    put(folder, name, text)
    os.utime(os.path.join(folder, name), (1_700_000_000 + seconds,) * 2)


@pytest.mark.parametrize("files_per_batch", [1, 2, 1000])
def test_versions_do_not_depend_on_batches(spark, tmp_path, landing, files_per_batch):
    """Three versions of one product in files whose names do not sort in the order they were written."""
    lake = Lake(spark, str(tmp_path / "lake"))
    folder = staging_path(landing, "products")
    for k, name in enumerate(["p_9.csv", "p_10.csv", "a.csv"]):
        write_at(folder, name, f"product_id,unit_price_usd\nP,{30 - k}\n", k)
    flows.ingest(lake, landing, ["products"], files_per_batch=files_per_batch)
    bronze = lake.bronze("products")
    versions = scd2(bronze, KEYS["products"]).orderBy(START).collect()
    assert [float(v.unit_price_usd) for v in versions] == [30, 29, 28]
    assert [v[END] is None for v in versions] == [False, False, True]
    assert float(keep_latest(bronze, ["product_id"]).first().unit_price_usd) == 28


def test_files_of_one_instant_are_ordered_by_counter(spark, lake, landing):
    folder = staging_path(landing, "products")
    for name, price in (("p_10.csv", 10), ("p_9.csv", 9)):
        write_at(folder, name, f"product_id,unit_price_usd\nP,{price}\nP,{price}.5\n", 0)
    flows.ingest(lake, landing, ["products"])
    assert float(keep_latest(lake.bronze("products"), ["product_id"]).first().unit_price_usd) == 10.5


def test_what_does_not_fit_is_rescued(spark, lake, landing):
    folder = staging_path(landing, "order_items")
    put(folder, "a.csv", "order_id,quantity,total_price_usd,cost_usd\nO1,2.7,$12.00,1.123456\nO2,3.0,7,1.5\nO3,1,1,1,EXTRA\n")
    flows.ingest(lake, landing, ["order_items"])
    found = {r.order_id: r for r in lake.bronze("order_items").collect()}
    assert found["O1"].quantity is None and found["O1"].total_price_usd is None
    assert json.loads(found["O1"]._rescued) == {"quantity": "2.7", "total_price_usd": "$12.00", "cost_usd": "1.123456"}
    assert found["O2"].quantity == 3 and found["O2"]._rescued is None
    assert "EXTRA" in found["O3"]._rescued and found["O3"].quantity == 1
    assert [r.rescued_rows for r in lake.rescued("order_items").collect()] == [2]


def test_extra_columns_in_another_case(spark, lake, landing):
    folder = staging_path(landing, "orders")
    put(folder, "a.csv", "order_id,Note\nO1,x\n")
    flows.ingest(lake, landing, ["orders"])
    put(folder, "b.csv", "order_id,note,odd`name\nO2,y,z\n")
    flows.ingest(lake, landing, ["orders"])
    bronze = lake.bronze("orders")
    assert {(r.order_id, r.Note) for r in bronze.collect()} == {("O1", "x"), ("O2", "y")}
    assert "odd`name" in bronze.columns


def test_late_backfill_and_rows_without_a_key_stay(spark, lake, tmp_path, landing):
    full = str(tmp_path / "full")
    os.makedirs(full)
    put(full, "orders.csv", "order_id,city\nO1,old\nO2,old\n,no key\n")
    put(staging_path(landing, "orders"), "a.csv", "order_id,city\nO1,new\n,no key\n,other\n")
    flows.ingest(lake, landing, ["orders"])
    flows.upsert(lake, "orders")
    flows.compact_current(lake, "orders")
    lake.backfill("orders", full)
    expected = [("", "no key"), ("", "no key"), ("", "other"), ("O1", "new"), ("O2", "old")]
    for _ in range(2):
        assert sorted((r.order_id or "", r.city) for r in flows.current(lake, "orders").collect()) == expected
        assert rows(flows.current(lake, "orders")) == rows(upserted("orders", lake.bronze("orders")))
        flows.compact_current(lake, "orders")


def test_a_rating_between_bands_is_not_rated(spark):
    bronze = spark.createDataFrame([("R1", "4.5"), ("R2", "4")], "order_id string, rating string")
    found = {r.order_id: r.rating_category for r in fact_reviews(silver.reviews(bronze), dt.date(2024, 1, 1)).collect()}
    assert found["R1"] == "not_rated" and found["R2"] != "not_rated"


def test_a_failed_job_leaves_the_old_version(spark, lake, landing):
    put(staging_path(landing, "products"), "a.csv", "product_id,brand\nP,old\n")
    flows.ingest(lake, landing, ["products"])
    lake.materialize(["products_silver"])
    before = lake.table("products_silver").collect()
    with pytest.raises(Exception, match="on purpose"):
        lake._store("products_silver", lake.table("products_silver").withColumn("x", F.raise_error(F.lit("on purpose"))), 0)
    assert lake.version("products_silver") == 0
    assert lake.table("products_silver").collect() == before
    lake.materialize(["products_silver"])
    assert lake.version("products_silver") == 1
    with pytest.raises(ValueError, match="not stored"):
        lake.table("fact_orders")

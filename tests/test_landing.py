"""Headers, inferred types, compaction and clearing up."""

import datetime as dt
import json
import os
import random
import shutil
import threading
import time

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_flows import ids, put

from shoplake.config import FULL_LOAD, METADATA, full_load_path, staging_path
from shoplake.functions import types
from shoplake.session import DROP_SHUFFLES, clear_scratch, scratch_dir, scratch_made, shuffles_dropped
from shoplake.sources import csv
from shoplake.sources import lake as lakes
from shoplake.streaming import flows, histories, sample_flows


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


# --- headers -------------------------------------------------------------------------------------------------------------
def test_one_scan_for_several_headers(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(folder, "a 1+b%20.csv", "order_id,city,note\nO1,here,x\nO2,there\nO3,a,b,c\n")
    put(folder, "b.csv", "\n  \ncity,order_id\nhome,O4\nnear,O5,more\nfar\n")
    put(f"{folder}/sub", "c.csv", "ORDER_ID\nO6\nO7,7,8\n")
    put(folder, "d.csv", "order_id,city,note\nO8,here,y\n")
    put(folder, "e.csv", "")
    found, extra = csv.read(spark, folder, {"order_id": "string", "city": "string"}, FULL_LOAD)
    assert extra == ["note"]
    got = {r.order_id: (r.city, r.note, json.loads(r._rescued)["_malformed_line"] if r._rescued else None) for r in found.collect()}
    assert got == {
        "O1": ("here", "x", None),
        "O2": ("there", None, "O2,there"),
        "O3": ("a", "b", "O3,a,b,c"),
        "O4": ("home", None, None),
        "O5": ("near", None, "near,O5,more"),
        None: ("far", None, "far"),
        "O6": (None, None, None),
        "O7": (None, None, "O7,7,8"),
        "O8": ("here", "y", None),
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Scan csv") == 1


def test_quotes_in_headers_and_values_of_several_headers(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(folder, "a.csv", 'order_id,"my note",city,city\nO1,"x, y",a,b\n')
    put(folder, "b.csv", '"my note",order_id\n"say ""no""",O2\n')
    found, extra = csv.read(spark, folder, {"order_id": "string", "city": "string"}, FULL_LOAD)
    got = {r["order_id"]: r["my note"] for r in found.collect()}
    assert got["O1"] == "x, y"
    assert "my note" in extra and not any(r._rescued for r in found.collect())


def test_files_without_a_line(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(folder, "a.csv", "")
    put(folder, "b.csv", "\n \n")
    found, extra = csv.read(spark, folder, {"order_id": "string"}, FULL_LOAD)
    assert found.collect() == [] and extra == []
    assert found.columns == ["order_id", *METADATA]


def test_header_lines_are_one_for_each_file(spark, tmp_path):
    folder = str(tmp_path / "in")
    for k in range(40):
        put(folder, f"{k:02}.csv", f"order_id,c{k % 3}\n" + "O1,x\n" * 50)
    found = csv.header_lines(spark, folder)
    assert found.count() == 40
    assert sorted(r.line for r in found.select("line").distinct().collect()) == ["order_id,c0", "order_id,c1", "order_id,c2"]


# --- types ---------------------------------------------------------------------------------------------------------------
def state_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return df.agg(types.type_state("v").alias("s")).select("s.*").first().asDict()


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([], "string"),
        ([None, " ", ""], "string"),
        (["1", "-20", None], "int"),
        (["1", "12345678901"], "bigint"),
        (["1", "1" * 25], "decimal(25,0)"),
        (["1", "1" * 40], "double"),
        (["1.50", "2", "-300"], "decimal(5,2)"),
        (["1.5", "2e3"], "double"),
        (["1", "x"], "string"),
        (["007", "1"], "string"),
        (["2024-01-02", " 2024-02-29 "], "date"),
        (["2024-02-30"], "string"),
        (["2024-01-02", "2024-01-02 03:04:05"], "timestamp"),
        (["2024-01-02", "5"], "string"),
        (["0", "0.0", "-0"], "decimal(2,1)"),
    ],
)
def test_types_of_values(spark, values, expected):
    assert types.type_of(state_of(spark, values)) == expected


WIDER = {"int": 0, "bigint": 1, "decimal": 2, "double": 3, "date": 4, "timestamp": 5, "string": 9}
VALUES = st.sampled_from(["1", "-7", "12345678901", "1.25", "3e4", "x", "2024-01-02", "2024-01-02 10:00:00", "01", "9" * 30])
COUNTED = st.lists(VALUES, min_size=1, max_size=6)


def plain_state(values):
    """The counts of ``type_state``, one value at a time."""
    import datetime as dt
    import re

    def fits(pattern, value):
        return bool(re.match(pattern, value)) and bool(dt.datetime.fromisoformat(value))

    out = dict.fromkeys([*types.COUNTS, *types.SIZES], 0)
    for v in values:
        tests = (True, re.match(types.WHOLE, v), re.match(types.DECIMAL, v), re.match(types.DOUBLE, v), fits(types.DATE, v), fits(types.INSTANT, v))
        for name, test in zip(types.COUNTS, tests, strict=True):
            out[name] += bool(test)
        if re.match(types.DECIMAL, v):
            whole, _, part = v.lstrip("+-").partition(".")
            out["digits"], out["scale"] = max(out["digits"], len(whole)), max(out["scale"], len(part))
    return out


def merge(a, b):
    return {k: a[k] + b[k] if k in types.COUNTS else max(a[k], b[k]) for k in a}


@settings(max_examples=200, deadline=None)
@given(COUNTED, COUNTED, COUNTED)
def test_states_merge_in_any_order_and_only_widen(a, b, c):
    sa, sb, sc = map(plain_state, (a, b, c))
    assert merge(merge(sa, sb), sc) == merge(sa, merge(sc, sb)) == plain_state([*b, *c, *a])
    narrow, wide = types.type_of(sa), types.type_of(merge(sa, sb))
    assert wide == narrow or WIDER[wide.split("(")[0]] >= WIDER[narrow.split("(")[0]]


def test_states_in_spark_are_those_of_the_values(spark):
    draw = random.Random(1)
    options = ["1", "-7", "12345678901", "1.25", "3e4", "x", "2024-01-02", "2024-01-02 10:00:00", "01", "9" * 30]
    values = [draw.choice(options) for _ in range(200)]
    assert state_of(spark, values) == plain_state(values)
    parts = spark.createDataFrame([tuple(plain_state(values[a : a + 20]).values()) for a in range(0, 200, 20)], types.STATE)
    assert parts.agg(*types.merged()).first().asDict() == plain_state(values)


def test_a_repeated_batch_does_not_count_twice(spark, lake, landing):
    folder = staging_path(landing, "orders")
    put(folder, "a.csv", "order_id,n.1,`odd`\nO1,1,2024-01-01\n")
    flows.ingest(lake, landing, ["orders"])
    assert lake.column_types("orders") == {"n.1": "int", "`odd`": "date"}
    for name in ("checkpoints", "staging"):
        shutil.rmtree(lake.path(name, "orders") if name == "checkpoints" else lake.path("staging", "orders"))
    put(folder, "b.csv", "order_id,N.1\nO2,2.5\n")
    flows.ingest(lake, landing, ["orders"])
    assert lake.column_types("orders")["n.1" if "n.1" in lake.column_types("orders") else "N.1"] == "decimal(2,1)"
    assert dict(lake.inferred("orders").dtypes)["`odd`"] == "date"


# --- compaction ------------------------------------------------------------------------------------------------------------
def deliver(lake, landing, numbers, entity="orders"):
    for k in numbers:
        put(staging_path(landing, entity), f"{k}.csv", f"order_id,city\nO{k},c{k}\n")
        flows.ingest(lake, landing, [entity])


def files(df):
    """How many files are read; pruned ones are not."""
    return df.select(F.input_file_name()).distinct().count()


def test_compaction_is_what_readers_read(spark, lake, landing, tmp_path):
    assert not lake.compact_bronze("orders")
    deliver(lake, landing, range(6))
    before = lake.bronze("orders")
    assert files(before) == 6
    expected = rows(before)
    assert lake.compact_bronze("orders")
    assert files(lake.bronze("orders")) == 1 and rows(lake.bronze("orders")) == expected
    assert not lake.compact_bronze("orders")
    deliver(lake, landing, range(6, 8))
    put(str(tmp_path / "full"), "orders.csv", "order_id,city\nO99,c\n")
    lake.backfill("orders", str(tmp_path / "full"))
    assert ids(lake.bronze("orders")) == sorted([*(f"O{k}" for k in range(8)), "O99"])
    assert files(lake.bronze("orders")) == 4
    assert lake.compact_bronze("orders")
    assert files(lake.bronze("orders")) == 2 and lake.bronze("orders").count() == 9


def test_a_batch_that_arrives_during_a_compaction(spark, lake, landing, monkeypatch):
    deliver(lake, landing, range(3))
    inner = type(lake)._incremental
    came = []

    def meanwhile(self, entity, schema, upto=None):
        parts = inner(self, entity, schema, upto)
        if upto is not None and not came:
            came.append(deliver(lake, landing, [3]))
        return parts

    monkeypatch.setattr(type(lake), "_incremental", meanwhile)
    assert lake.compact_bronze("orders")
    assert ids(lake.bronze("orders")) == ["O0", "O1", "O2", "O3"]
    assert files(lake.bronze("orders")) == 2


def test_an_interrupted_compaction_changes_nothing(spark, lake, landing):
    deliver(lake, landing, range(3))
    lake.compact_bronze("orders")
    deliver(lake, landing, [3])
    expected = rows(lake.bronze("orders"))
    # The next version was written in part, and has no mark.
    lake.bronze("orders").limit(1).write.parquet(lake.path("bronze", "orders", "base", "version=1"))
    assert rows(lake.bronze("orders")) == expected
    assert lake.compact_bronze("orders")
    assert rows(lake.bronze("orders")) == expected


def test_columns_that_came_after_a_compaction(spark, lake, landing):
    deliver(lake, landing, range(2))
    lake.compact_bronze("orders")
    put(staging_path(landing, "orders"), "z.csv", "order_id,channel\nO9,app\n")
    flows.ingest(lake, landing, ["orders"])
    assert sorted((r.order_id, r.channel) for r in lake.bronze("orders").collect()) == [("O0", None), ("O1", None), ("O9", "app")]


def test_a_snapshot_names_what_it_read(spark, lake, landing, tmp_path, monkeypatch):
    """A backfill and a batch that land while a snapshot is written are taken in once, after it."""
    put(staging_path(landing, "orders"), "a.csv", "order_id,city\nO1,a\n,none\n")
    flows.ingest(lake, landing, ["orders"])
    flows.upsert(lake, "orders")
    inner, came = flows._merged, []

    def meanwhile(*args):
        found = inner(*args)
        if not came:
            came.append(True)
            put(str(tmp_path / "full"), "orders.csv", "order_id,city\nO2,b\n,old\n")
            lake.backfill("orders", str(tmp_path / "full"))
            put(staging_path(landing, "orders"), "b.csv", "order_id,city\nO3,c\n,new\n")
            flows.ingest(lake, landing, ["orders"])
            flows.upsert(lake, "orders")
        return found

    monkeypatch.setattr(flows, "_merged", meanwhile)
    flows.compact_current(lake, "orders")
    for _ in range(2):
        found = sorted((r.order_id or "", r.city) for r in flows.current(lake, "orders").collect())
        assert found == [("", "new"), ("", "none"), ("", "old"), ("O1", "a"), ("O2", "b"), ("O3", "c")]
        flows.compact_current(lake, "orders")


# --- clearing up -----------------------------------------------------------------------------------------------------------
def test_vacuum_keeps_the_newest_versions(spark, lake, landing):
    for k in range(4):
        deliver(lake, landing, [k])
        lake.compact_bronze("orders")
        lake.materialize(["orders_silver"])
    put(staging_path(landing, "products"), "a.csv", "product_id,brand\nP,x\n")
    flows.ingest(lake, landing, ["products"])
    histories.maintain_history(lake, "products")
    for _ in range(3):
        histories.compact_history(lake, "products")
    unmarked = lake.path("tables", "orders_silver", "version=9")
    lake.table("orders_silver").write.parquet(unmarked)
    removed = lake.vacuum(keep=2)
    assert len(removed) == 2 + 2 + 1
    assert lake.vacuum(keep=2) == []
    assert os.path.isdir(unmarked)
    assert ids(lake.bronze("orders")) == ids(lake.table("orders_silver")) == [f"O{k}" for k in range(4)]
    assert histories.history(lake, "products").count() == 1


def test_scratch_folders_can_be_cleared(spark):
    made = scratch_dir(spark, "x")
    spark.range(3).write.parquet(made)
    assert made in clear_scratch(spark)
    assert not os.path.exists(made)
    assert clear_scratch(spark) == []
    assert scratch_dir(spark, "y") != made


def test_history_marks_are_no_columns_of_versions(spark, lake, landing):
    put(staging_path(landing, "products"), "a.csv", "product_id,brand\nP,x\n")
    flows.ingest(lake, landing, ["products"])
    histories.maintain_history(lake, "products")
    assert "_shown" not in histories.history(lake, "products").columns


# --- what does not fit its type ------------------------------------------------------------------------------------------
TEXTS = [None, "", " ", "12", " 12 ", "+12", "-7", "007", "12.", "12.0", "12.5", "1e3", "1E3", "1.5e-7", "0x1p3", "12d", "five", "2147483647", "2147483648"]
TEXTS += ["2147483646.0000000001", "1.00000000000000000001", "0.1234", "0.12340", "0.12345", "0.00001", "1.5e2", "99999999999999.9999", "999999999999999", "NaN", "-Infinity", "1,5", "._", "."]


@pytest.mark.parametrize("kind", ["int", "decimal(18,4)", "decimal(18,0)", "double", "date"])
def test_rescued_texts_are_those_that_change(spark, kind):
    """Against the plain rule: typed, and compared digit by digit with what was typed."""
    number = "try_cast(x AS double)"
    made = f"IF({number} = floor({number}), try_cast({number} AS int), NULL)" if kind == "int" else f"try_cast(x AS {kind})"
    changed = f"coalesce(try_cast(x AS decimal(38,12)) <> CAST({made} AS decimal(38,12)), FALSE)" if kind.startswith(("int", "dec")) else "FALSE"
    plain = spark.createDataFrame([(k, x) for k, x in enumerate(TEXTS)], "k int, x string")
    expected = plain.selectExpr("k", f"{made} AS made", f"IF(trim(x) <> '' AND ({made} IS NULL OR {changed}), x, NULL) AS kept")
    rows_ = plain.withColumns({csv.MALFORMED: F.lit(None).cast("string"), "_text0": F.lit("a column of this name"), "_source_file": F.lit("f")})
    rows_ = rows_.withColumns({"_changed_at": F.lit(None).cast("timestamp"), "_source_block": F.lit(0).cast("long"), "_source_row": F.lit(0).cast("long")})
    found = csv._shape(rows_, {"k": "string", "x": kind}, "full_load")
    texts = found.selectExpr("CAST(k AS int) AS k", "x AS made", "get_json_object(_rescued, '$.x') AS kept")
    assert sorted(map(str, texts.collect())) == sorted(map(str, expected.collect()))
    assert found.filter("_rescued IS NOT NULL AND get_json_object(_rescued, '$.x') IS NULL").isEmpty()


def test_rows_that_fit_build_no_json(spark, tmp_path):
    """A text is turned into its type once, and the whole step is generated code."""
    put(str(tmp_path), "a.csv", "id,price,n\n1,2.50,3\n")
    found, _ = csv.read(spark, str(tmp_path), {"id": "string", "price": "decimal(18,4)", "n": "int"}, "full_load")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "map_filter" not in plan and plan.count("as decimal(18,4))") == 1


# --- disk ----------------------------------------------------------------------------------------------------------------
def shuffle_files(spark):
    kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(kept.length()) if (name := kept.apply(k).getName()).startswith("shuffle_")}


def land_sales(spark, lake, tmp_path):
    full = str(tmp_path / "full")
    numbers = range(40)
    put(full, "orders.csv", "order_id,customer_id,order_date\n" + "".join(f"O{i},C{i % 7},2024-01-{1 + i % 9:02}\n" for i in numbers))
    put(full, "order_items.csv", "order_id,product_id,customer_id,quantity,total_price_usd\n" + "".join(f"O{i // 2},P{i % 5},C{i % 7},2,{i}.5\n" for i in numbers))
    put(full, "payments.csv", "payment_id,order_id,customer_id,payment_method\n" + "".join(f"Y{i},O{i},C{i % 7},card\n" for i in numbers))
    put(full, "shipping.csv", "shipping_id,order_id,customer_id,delivery_days\n" + "".join(f"S{i},O{i},C{i % 7},{i % 12}\n" for i in numbers))
    for entity in ("orders", "order_items", "payments", "shipping"):
        assert lake.backfill(entity, full)


SALES = [f"{e}_silver" for e in ("orders", "order_items", "payments", "shipping")] + ["fact_orders", "fact_order_items", "fact_shipping", "agg_daily_sales"]


def test_shuffle_files_go_as_tables_are_stored(spark, lake, tmp_path):
    land_sales(spark, lake, tmp_path)
    held, set_before = shuffle_files(spark), spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lake.materialize(SALES)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    until = time.time() + 20
    while shuffle_files(spark) - held and time.time() < until:  # they go in the background
        time.sleep(0.2)
    assert not shuffle_files(spark) - held
    assert spark.conf.get(DROP_SHUFFLES, None) == set_before
    assert lake.table("fact_orders").count() == 40 and lake.table("fact_order_items").count() == 40
    assert lake.table("agg_daily_sales").agg(F.sum("total_line_items")).first()[0] == 40


def test_setting_for_shuffle_files_is_put_back(spark):
    spark.conf.set(DROP_SHUFFLES, "false")
    try:
        with pytest.raises(ValueError, match="stop"), shuffles_dropped(spark):
            with shuffles_dropped(spark):
                pass
            assert spark.conf.get(DROP_SHUFFLES) == "true"
            raise ValueError("stop")
        assert spark.conf.get(DROP_SHUFFLES) == "false"
    finally:
        spark.conf.unset(DROP_SHUFFLES)


@pytest.mark.parametrize("large", [True, False])
def test_large_tables_are_made_one_at_a_time(spark, lake, tmp_path, monkeypatch, large):
    land_sales(spark, lake, tmp_path)
    running, most, store, lock = [], [0], lakes.Lake._store, threading.Lock()

    def slow(self, name, made, buckets):
        with lock:
            running.append(name)
            most[0] = max(most[0], len(running))
        time.sleep(0.5)
        store(self, name, made, buckets)
        with lock:
            running.remove(name)

    monkeypatch.setattr(lakes.Lake, "_store", slow)
    monkeypatch.setattr(lakes, "ALONE_FROM", 0 if large else 1 << 40)
    lake.materialize(SALES)
    assert (most[0] == 1) == large
    assert lake.table("fact_orders").count() == 40


def test_lake_files_are_packed(spark, lake, tmp_path):
    land_sales(spark, lake, tmp_path)
    put(staging_path(str(tmp_path / "in"), "orders"), "a.csv", "order_id\nO99\n")
    flows.ingest(lake, str(tmp_path / "in"), ["orders"])
    lake.materialize(["orders_silver"])
    for part in ("bronze/orders/full", "bronze/orders/incremental/batch_id=0", "staging/orders/batch_id=0", "tables/orders_silver/version=0"):
        names = [n for n in os.listdir(lake.path(*part.split("/"))) if n.endswith(".parquet")]
        assert names and all(n.endswith(".zstd.parquet") for n in names)
    assert len(ids(lake.table("orders_silver"))) == 41


def test_sample_files_are_packed_and_full_ones_dropped_once_loaded(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(sample_flows.PACKED, "maxRecordsPerFile", "30")
    t = sample_flows.Trial(spark, str(tmp_path))
    sent = spark.range(0, 100, 1, 1).selectExpr("CAST(id AS STRING) AS payment_id", "' blank ' AS payment_method", "IF(id % 10 = 0, NULL, id) AS order_id")
    t.send_full("payments", sent)
    t.send("payments", sent.limit(3))
    folder = full_load_path(t.full, "payments")
    files = [n for n in os.listdir(folder) if n.startswith("part-")]
    assert len(files) == 4 and all(n.endswith(".csv.gz") for n in files)
    t.load_full("payments")
    assert not os.path.exists(folder)
    t.load_full("payments")
    flows.ingest(t.lake, t.landing, ["payments"])
    assert [n for n in os.listdir(staging_path(t.landing, "payments")) if n.startswith("part-")]
    landed = t.lake.bronze("payments")
    assert landed.groupBy("_load_type").count().orderBy("count").collect() == [("incremental", 3), ("full_load", 100)]
    found = landed.filter("_load_type = 'full_load'")
    assert rows(found.select(*sent.columns)) == rows(sent.withColumn("order_id", F.col("order_id").cast("string")))
    # Files and rows keep the order in which rows were sent.
    placed = found.orderBy(F.length("_source_file"), "_source_file", "_source_block", "_source_row")
    assert [int(r[0]) for r in placed.select("payment_id").collect()] == list(range(100))


def test_stored_daily_sales_keeps_no_full_file_and_no_shuffle(spark, tmp_path):
    day, money = "DATE '1997-01-01' + CAST(id % 5 AS INT)", "CAST(100 + id AS DECIMAL(15,2))"
    made = {
        "orders": f"id AS o_orderkey, id % 7 AS o_custkey, 'F' AS o_orderstatus, {money} AS o_totalprice, {day} AS o_orderdate, '1-URGENT' AS o_orderpriority",
        "lineitem": f"id % 30 AS l_orderkey, id % 4 AS l_partkey, 1 + id % 4 AS l_linenumber, 5 AS l_quantity, {money} AS l_extendedprice, 0.05 AS l_discount, 0.02 AS l_tax, 'A' AS l_returnflag, 'F' AS l_linestatus",
        "part": "id AS p_partkey, 'name' AS p_name, 'type' AS p_type, 'brand' AS p_brand, CAST(1 + id AS INT) AS p_size, CAST(9 AS DECIMAL(15,2)) AS p_retailprice",
    }
    for name, columns in made.items():
        number = {"orders": 30, "lineitem": 90, "part": 4}[name]
        spark.range(number).selectExpr(f"struct({columns}) AS r").select("r.*").write.parquet(str(tmp_path / f"{name}.parquet"))
    held, folders = shuffle_files(spark), set(scratch_made(spark))
    sold = sample_flows.stored_daily_sales(spark, str(tmp_path))
    left = lambda: {name.split("_")[1] for name in shuffle_files(spark) - held}
    until = time.time() + 20
    while len(left()) > 1 and time.time() < until:
        time.sleep(0.2)
    assert len(left()) <= 1  # that of the result's version, which is looked up last
    (base,) = {f for f in scratch_made(spark) if "/flow-" in f} - folders
    assert os.listdir(f"{base}/full") == []
    assert rows(sold.select("order_date", "total_orders", "total_line_items")) == [str((dt.date(1997, 1, 1 + d), 18, 6)) for d in range(5)]

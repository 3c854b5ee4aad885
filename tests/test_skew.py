"""Heavy keys change the plan, never the result."""

import datetime as dt
import random

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from __spark_entry__ import Sample
from shoplake.functions.shape import publish
from shoplake.operators import history, skew
from shoplake.operators.dedup import keep_latest


def lopsided(spark, n, name):
    """A third of the rows under one key, a third without key, every row twice."""
    data = [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 40}", f"{name}{i // 2}") for i in range(n)]
    return spark.createDataFrame(data + data, f"k string, {name} string").repartition(3)


def test_heavy_keys(spark, heavy):
    spark.conf.set(skew.SHARE, "0.2")
    df = lopsided(spark, 300, "a")
    assert set(skew.heavy_keys(df, "k")[0]) == {"hot", None}
    assert skew.heavy_keys(df, F.lit(1), "a") == [[1], []]


def test_small_tables_have_no_heavy_keys(spark):
    assert skew.heavy_keys(lopsided(spark, 300, "a"), "k") == [[]]


def test_heavy_keys_from_a_share_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "SEEN", 2000)
    spark.conf.set(skew.MIN_ROWS, "20000")
    try:
        key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, 1).otherwise(F.col("id"))
        df = spark.range(100_000).select(key.alias("k"))
        assert skew.heavy_keys(df, "k") == [[0]]
    finally:
        spark.conf.unset(skew.MIN_ROWS)


def test_enrich(spark, heavy):
    left = lopsided(spark, 300, "a")
    one = left.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    two = one.select("k", (F.col("n") * 2).alias("m")).filter("k <> 'k5'")
    expected = left.join(one, "k", "left").join(two, "k", "left")
    assert rows(skew.enrich(left, [one, two], "k")) == rows(expected)
    assert rows(skew.enrich(left, [one, two], "k", heavy=["hot"])) == rows(expected)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("left_n, right_n", [(300, 300), (300, 60), (30, 300)])
def test_scatter_join(spark, heavy, how, left_n, right_n):
    left, right = lopsided(spark, left_n, "a"), lopsided(spark, right_n, "b")
    assert rows(skew.scatter_join(left, right, "k", how)) == rows(left.join(right, "k", how))


def test_scatter_join_when_the_right_side_is_heavy_alone(spark, heavy):
    left = spark.createDataFrame([("hot", 1), ("hot", 2), ("other", 3), (None, 4)], "k string, a int")
    right = lopsided(spark, 300, "b")
    spark.conf.set(skew.SHARE, "0.3")
    assert rows(skew.scatter_join(left, right, "k")) == rows(left.join(right, "k", "left"))


@pytest.mark.parametrize("name", ["fact_orders", "fact_order_items", "fact_shipping", "agg_customer_metrics"])
def test_tables_with_heavy_keys(spark, name):
    def made():
        s = Sample(spark, SF)
        s.bronze = lambda entity: gathered(Sample.bronze(s, entity))
        return rows(publish(s[name]))

    def gathered(df):
        """A third of every entity's rows under one order and one customer, some without either."""
        for key in ("order_id", "customer_id"):
            if key in df.columns:
                number = F.pmod(F.xxhash64(key), F.lit(30))
                df = df.withColumn(key, F.when(number < 3, F.lit("hot")).when(number == 10, F.lit(None)).otherwise(F.col(key)))
        return df

    plain = made()
    spark.conf.set(skew.MIN_ROWS, "1")
    spark.conf.set(skew.SHARE, "0.02")
    spark.conf.set(skew.WAYS, "4")
    try:
        assert made() == plain
    finally:
        for setting in (skew.MIN_ROWS, skew.SHARE, skew.WAYS):
            spark.conf.unset(setting)


def change_log(spark, seed, with_null_times=True):
    pick = random.Random(seed)
    data = []
    for i in range(600):
        key = "hot" if pick.random() < 0.5 else f"k{pick.randrange(40)}"
        at = None if with_null_times and pick.random() < 0.02 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=pick.randrange(200))
        data.append((key, pick.choice("xyz"), pick.choice([None, 1]), at))
    return spark.createDataFrame(data, "k string, a string, b int, _ingestion_timestamp timestamp").repartition(3)


def brute_versions(df):
    logs = {}
    low = dt.datetime(1, 1, 1)
    for r in df.collect():
        logs.setdefault(r.k, {}).setdefault(r._ingestion_timestamp or low, []).append((r.a, r.b))
    found = []
    for key, instants in logs.items():
        kept = []
        for at in sorted(instants):
            state = max(instants[at], key=lambda s: (s[0], s[1] is not None, s[1] or 0))
            if not kept or kept[-1][1] != state:
                kept.append((at, state))
        for (at, state), after in zip(kept, kept[1:] + [(None, None)]):
            found.append((key, *state, None if at == low else at, after[0]))
    return sorted(map(str, found))


@pytest.mark.parametrize("seed", range(3))
def test_scd2_of_heavy_keys(spark, heavy, seed, monkeypatch):
    log = change_log(spark, seed)
    expected = brute_versions(log)

    def found():
        made = history.scd2(log, ["k"]).select("k", "a", "b", history.START, history.END)
        return sorted(str(tuple(r)) for r in made.collect())

    monkeypatch.setattr(history, "PIECES", 7)
    assert found() == expected
    spark.conf.set(skew.MIN_ROWS, "1000000")
    assert found() == expected


@pytest.mark.parametrize("seed", range(2))
def test_as_of_against_brute_force(spark, heavy, seed, monkeypatch):
    monkeypatch.setattr(history, "PIECES", 7)
    versions = history.scd2(change_log(spark, seed, False), ["k"]).select("k", "a", "b", history.START, history.END)
    pick = random.Random(seed)
    data = [
        (i, pick.choice(["hot", "hot", f"k{pick.randrange(45)}", None]), None if i % 50 == 0 else dt.datetime(2023, 12, 31) + dt.timedelta(minutes=pick.randrange(15000)))
        for i in range(400)
    ]
    facts = spark.createDataFrame(data, "i int, k string, at timestamp")
    known = versions.collect()
    expected = []
    for i, k, at in data:
        hit = [v for v in known if k is not None and at is not None and v.k == k and v[history.START] <= at and (v[history.END] is None or at < v[history.END])]
        assert len(hit) <= 1
        expected.append((i, hit[0].a, hit[0].b) if hit else (i, None, None))

    def found():
        return sorted(tuple(r) for r in history.as_of(facts, versions, ["k"], "at").select("i", "a", "b").collect())

    assert found() == sorted(expected)
    spark.conf.set(skew.MIN_ROWS, "1000000")
    assert found() == sorted(expected)


def test_scd2_with_composite_keys(spark, heavy):
    log = change_log(spark, 5).withColumn("k2", F.when(F.col("k") == "hot", F.lit(None)).otherwise(F.lit(1)))
    one = history.scd2(log.drop("k2"), ["k"]).select("k", "a", "b", history.START, history.END)
    two = history.scd2(log, ["k", "k2"]).select("k", "a", "b", history.START, history.END)
    assert rows(one) == rows(two)


def test_scd2_properties(spark):
    log = change_log(spark, 9, False)
    made = history.scd2(log, ["k"])
    keys = log.select("k").distinct().count()
    assert made.filter(F.col(history.END).isNull()).count() == keys
    assert made.filter(F.col(history.END) <= F.col(history.START)).count() == 0
    # The open version holds the state of the newest row of each key.
    open_rows = made.filter(F.col(history.END).isNull()).select("k", "a", "b")
    assert rows(open_rows) == rows(keep_latest(log, ["k"]).select("k", "a", "b"))


def test_late_change_splits_an_interval(spark):
    at = [dt.datetime(2024, 1, d) for d in (1, 3, 5)]
    log = spark.createDataFrame([("p", "x", at[0]), ("p", "x", at[2])], "k string, a string, _ingestion_timestamp timestamp")
    assert history.scd2(log, ["k"]).count() == 1
    late = log.unionByName(spark.createDataFrame([("p", "y", at[1])], log.schema))
    made = history.scd2(late, ["k"]).orderBy(history.START).collect()
    assert [(r.a, r[history.START], r[history.END]) for r in made] == [("x", at[0], at[1]), ("y", at[1], at[2]), ("x", at[2], None)]


def test_keep_latest_is_idempotent_and_prunes_before_the_shuffle(spark):
    log = change_log(spark, 4)
    once = keep_latest(log, ["k"])
    assert rows(keep_latest(once, ["k"])) == rows(once)
    assert "WindowGroupLimit" in once._jdf.queryExecution().toString()


@pytest.mark.parametrize("partitions", ["1", "16"])
def test_results_do_not_depend_on_partitioning(spark, partitions):
    expected = rows(publish(Sample(spark, SF)["agg_daily_sales"]))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert rows(publish(Sample(spark, SF)["agg_daily_sales"])) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_the_limit_does_not_rise_with_the_table(spark):
    """One key of 30,000 rows is found among 40,000 rows and among 400,000."""
    spark.conf.set(skew.MIN_ROWS, "20000")
    try:
        for n in (40_000, 400_000):
            df = spark.range(n).select(F.when(F.col("id") < 30_000, F.lit(-1)).otherwise(F.col("id")).alias("k"))
            (found,) = skew.heavy_counts(df, "k")
            assert list(found) == [-1] and 29_000 < found[-1] < 31_000
    finally:
        spark.conf.unset(skew.MIN_ROWS)


def test_slices_follow_the_rows_of_a_key(spark):
    df = spark.range(1)
    spark.conf.set(skew.ROWS_PER_TASK, "1000")
    try:
        assert skew.slices_of(df, {"a": 10, "b": 64_001, None: 10**9}) == {"a": 8, "b": 65, None: 10**6}
    finally:
        spark.conf.unset(skew.ROWS_PER_TASK)


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parquet")


def all_heavy(monkeypatch):
    """Whatever the table, its keys 1 and 3 count as heavy on both sides."""
    monkeypatch.setattr(skew, "heavy_counts", lambda df, *keys: [{"1": 10, "3": 10} for _ in keys])


@pytest.mark.parametrize("name", ["fact_orders", "fact_order_items", "fact_shipping", "agg_customer_metrics", "agg_daily_sales"])
def test_tables_are_read_once_with_heavy_keys_too(spark, monkeypatch, name):
    first = Sample(spark, SF)[name]
    plain, expected = scans(first), rows(publish(first))
    all_heavy(monkeypatch)
    made = Sample(spark, SF)[name]
    assert scans(made) == plain
    assert "_ways" in made._jdf.queryExecution().optimizedPlan().toString()
    assert rows(publish(made)) == expected


def test_fraud_report_reads_tables_once_with_heavy_keys(spark, monkeypatch):
    from shoplake.plans import reports

    def made():
        s = Sample(spark, SF)
        return reports.fraud_orders(s["fact_orders"], s["risk_support_silver"])

    plain, expected = scans(made()), rows(made())
    all_heavy(monkeypatch)
    assert scans(made()) == plain and rows(made()) == expected


def test_as_of_of_few_versions_is_one_join(spark, monkeypatch):
    """Facts of heavy keys are sliced; no more exchanges than one for each side, with broadcasts off."""
    versions = history.scd2(change_log(spark, 3, False), ["k"]).select("k", "a", "b", history.START, history.END).filter("k <> 'hot'")
    versions = spark.createDataFrame(versions.collect(), versions.schema)
    facts = spark.range(500).selectExpr("id AS i", "concat('k', id % 45) AS k", "TIMESTAMP '2024-01-01' + make_dt_interval(0, id % 230) AS at")
    plain = rows(history.as_of(facts, versions, ["k"], "at"))
    assert len(plain) == 500
    monkeypatch.setattr(skew, "heavy_counts", lambda df, *keys, min_rows=None: [{} if min_rows else {"k1": 10, "k3": 99} for _ in keys])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = history.as_of(facts, versions, ["k"], "at")
        plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan
        assert rows(made) == plain
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

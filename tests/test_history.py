"""Stored histories that are kept up, and the order of changes behind them."""

import datetime as dt
import os
import random
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shoplake.config import staging_path
from shoplake.operators import history as H
from shoplake.operators import history
from shoplake.operators.dedup import keep_latest, newest
from shoplake.streaming import flows, histories

LOG = "k string, a int, b string, _ingestion_timestamp timestamp, _changed_at timestamp, _source_file string, _load_type string"
T0 = dt.datetime(2024, 1, 1)


def log(seed, n, keys=6, full=0.2):
    """Changes with few distinct times, so that many are late, equal or of one instant; some are from a backfill."""
    draw, out = random.Random(seed), []
    for i in range(n):
        key = None if draw.random() < 0.1 else "hot" if draw.random() < 0.4 else f"k{draw.randrange(keys)}"
        kind = "full_load" if draw.random() < full else "incremental"
        at = None if draw.random() < 0.05 else T0 + dt.timedelta(draw.randrange(25))
        out.append((key, draw.randrange(2), draw.choice("xy"), T0 + dt.timedelta(100, i // 7), at, f"f{draw.randrange(12)}.csv", kind))
    return out


def stored_after(spark, batches):
    """Feed batches to a history held in memory; returns it with the rows that each batch altered."""
    changes = spark.createDataFrame([], LOG)
    schema = changes.select("*", *(F.lit(None).cast(t).alias(n) for n, t in ((history.START, "timestamp"), (history.END, "timestamp"), (history.SHOWN, "boolean")))).schema
    held, altered = {}, []
    for batch in batches:
        stored = spark.createDataFrame([tuple(v[n] for n in schema.names) for v in held.values()], schema)
        found = [r.asDict() for r in history.maintain(stored, spark.createDataFrame(batch, LOG), ["k"]).collect()]
        altered.append(found)
        for row in found:
            name = (row["k"], row["_changed_at"])
            if row[history.GONE]:
                held.pop(name)
            else:
                held[name] = row
    return spark.createDataFrame([tuple(v[n] for n in schema.names) for v in held.values()], schema), altered


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("many", [False, True])
def test_a_history_kept_up_is_that_of_the_whole_log(spark, request, seed, many):
    if many:
        request.getfixturevalue("heavy")
    made = log(seed, 150)
    cuts = sorted(random.Random(seed).sample(range(1, 150), 4))
    batches = [made[a:b] for a, b in zip([0, *cuts], [*cuts, 150], strict=True)]
    stored, _ = stored_after(spark, batches)
    whole = history.scd2(spark.createDataFrame(made, LOG), ["k"])
    assert rows(history.versions(stored)) == rows(whole)


def test_heavy_keys_have_the_same_versions(spark, request):
    changes = spark.createDataFrame(log(9, 400), LOG)
    plain = rows(history.scd2(changes, ["k"]))
    request.getfixturevalue("heavy")
    assert rows(history.scd2(changes, ["k"])) == plain


def change(key, value, day, kind="incremental", loaded=0, file="f.csv"):
    return (key, value, "x", T0 + dt.timedelta(100 + loaded), T0 + dt.timedelta(day), file, kind)


def spans(df, key="k1"):
    kept = df.filter(F.col("k") == key).orderBy(F.col(history.START)).collect()
    return [(r.a, (r[history.START] - T0).days, r[history.END] and (r[history.END] - T0).days) for r in kept]


def test_a_late_change_splits_the_version_it_falls_in(spark):
    first = [change(f"k{i}", 1, 0) for i in range(50)] + [change("k1", 2, 10), change("k1", 3, 20)]
    stored, altered = stored_after(spark, [first, [change("k1", 9, 5)]])
    assert spans(history.versions(stored)) == [(1, 0, 5), (9, 5, 10), (2, 10, 20), (3, 20, None)]
    # Of 52 stored rows, one neighbour is rewritten beside the new one; versions from day 10 on stay.
    assert sorted((r["k"], (r["_changed_at"] - T0).days) for r in altered[1]) == [("k1", 0), ("k1", 5)]


def test_a_report_of_nothing_new_becomes_a_version_when_a_late_change_comes_before_it(spark):
    stored, altered = stored_after(spark, [[change("k1", 1, 0), change("k1", 1, 10)], [change("k1", 2, 5)]])
    assert spans(history.versions(stored)) == [(1, 0, 5), (2, 5, 10), (1, 10, None)]
    assert len(altered[1]) == 3


def test_a_batch_fed_twice_alters_nothing(spark):
    made = log(3, 80)
    stored, altered = stored_after(spark, [made, made, []])
    assert altered[1] == altered[2] == []
    assert rows(history.versions(stored)) == rows(history.scd2(spark.createDataFrame(made, LOG), ["k"]))


def test_only_keys_of_the_batch_are_altered(spark):
    made = log(5, 200)
    later = [change("k2", 7, 500), change("new", 1, 3)]
    _, altered = stored_after(spark, [made, later])
    assert {r["k"] for r in altered[1]} == {"k2", "new"}


def test_a_backfill_ends_at_the_first_increment(spark):
    old, new = change("k1", 1, 5, "full_load"), change("k1", 2, 10)
    for order in ([[old], [new]], [[new], [old]]):
        stored, _ = stored_after(spark, order)
        assert spans(history.versions(stored)) == [(1, 5, 10), (2, 10, None)]
    # An increment from before the backfill's time leaves no time for it, in whichever order they come.
    early = change("k1", 3, 2)
    for order in ([[old, new], [early]], [[early], [old], [new]], [[early, old, new]]):
        stored, _ = stored_after(spark, order)
        assert spans(history.versions(stored)) == [(3, 2, 10), (2, 10, None)]


@pytest.mark.parametrize("later", [0, 400])
def test_increments_beat_a_backfill_whatever_the_file_times(spark, later):
    """The backfill's file has the increment's time or one a year later, and is loaded later still."""
    made = [change("k1", 1, 5 + later, "full_load", loaded=9, file="z.csv"), change("k1", 2, 5), change("k1", 3, 5, loaded=1)]
    df = spark.createDataFrame(made, LOG)
    assert [r.a for r in keep_latest(df, ["k"]).collect()] == [3]
    assert [r.n.a for r in df.groupBy("k").agg(newest("a", of=df.columns).alias("n")).collect()] == [3]
    assert [r.a for r in history.scd1(df.limit(1), df, ["k"]).collect()] == [3]
    assert [r.a for r in history.scd2(df, ["k"]).filter(F.col(history.END).isNull()).collect()] == [3]


def test_newest_is_the_same_row_as_keep_latest(spark):
    df = spark.createDataFrame(log(11, 300), LOG)
    order = ["_load_type", "_changed_at", "_ingestion_timestamp", "_source_file"]
    of_group = df.groupBy("k").agg(newest(*order, "a", "b", of=df.columns).alias("n")).select("k", "n.a", "n.b", *(f"n.{c}" for c in order))
    assert rows(of_group) == rows(keep_latest(df, ["k"]).select(*of_group.columns))


# --- the stored flow -------------------------------------------------------------------------------------------------------
def put(folder, name, text, day):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    Path(path).write_text(text)
    os.utime(path, ((T0 + dt.timedelta(day)).timestamp(),) * 2)


def same_as_whole(lake):
    bronze = lake.bronze("products")
    kept = histories.history(lake, "products")
    whole = history.scd2(bronze.select(*kept.drop(history.START, history.END).columns), ["product_id"])
    assert rows(kept) == rows(whole)
    return [float(r.unit_price_usd) for r in kept.filter("product_id = 'P1'").orderBy(history.START).collect()]


def test_stored_history(spark, lake, tmp_path):
    landing, full = str(tmp_path / "landing"), str(tmp_path / "full")
    folder = staging_path(landing, "products")

    def take():
        flows.ingest(lake, landing, ["products"])
        histories.maintain_history(lake, "products")
        return same_as_whole(lake)

    put(folder, "a.csv", "product_id,unit_price_usd\nP1,10\nP2,1\n", 10)
    assert take() == [10]
    put(folder, "b.csv", "product_id,unit_price_usd\nP1,12\n", 12)
    histories.compact_history(lake, "products")
    assert take() == [10, 12]
    put(folder, "c.csv", "product_id,unit_price_usd\nP1,11\nP3,5\n", 11)
    assert take() == [10, 11, 12]
    put(full, "products.csv", "product_id,unit_price_usd\nP1,9\nP4,4\n", 9)
    lake.backfill("products", full)
    assert take() == [9, 10, 11, 12]
    histories.compact_history(lake, "products")
    assert same_as_whole(lake) == [9, 10, 11, 12]
    put(folder, "d.csv", "product_id,unit_price_usd\nP1,8\n", 8)
    assert take() == [8, 10, 11, 12]
    # Rows of the last batch: the new one, and the backfilled one that no longer counts.
    last = histories._generations(lake, "products").filter(F.col("generation") == histories._last_generation(lake, "products"))
    assert sorted((r.product_id, r[history.GONE]) for r in last.collect()) == [("P1", False), ("P1", True)]


def test_a_repeated_history_batch_replaces_itself(spark, lake, tmp_path):
    landing = str(tmp_path / "landing")
    for k, day in enumerate((1, 3, 2)):
        put(staging_path(landing, "products"), f"{k}.csv", f"product_id,unit_price_usd\nP1,{day}\n", day)
        flows.ingest(lake, landing, ["products"])
        histories.maintain_history(lake, "products")
    before = rows(histories.history(lake, "products"))
    commits = lake.path("checkpoints", "products", "history", "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.remove(os.path.join(commits, name))
    shutil.rmtree(lake.path("history", "products", "changes", f"generation={2 * int(last) + 1}"))
    histories.maintain_history(lake, "products")
    assert rows(histories.history(lake, "products")) == before


def test_the_key_range_of_a_batch_reaches_the_files(spark, lake, tmp_path):
    landing = str(tmp_path / "landing")
    text = "".join(f"P{i:04},{i}\n" for i in range(500))
    put(staging_path(landing, "products"), "a.csv", "product_id,unit_price_usd\n" + text, 1)
    flows.ingest(lake, landing, ["products"])
    histories.maintain_history(lake, "products")
    histories.compact_history(lake, "products")
    batch = spark.createDataFrame([("P0007",), ("P0009",)], "product_id string")
    found = histories.stored_history(lake, "products", changes=batch)
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(product_id,P0007)" in plan and "LessThanOrEqual(product_id,P0009)" in plan


# --- the entry without the text operators --------------------------------------------------------------------------------
def test_entry_imports_without_the_text_operators(tmp_path):
    root = Path(__file__).resolve().parent.parent
    for part in ("shoplake", "oracle", "__spark_entry__.py", "corpus_pipeline.py"):
        copy = shutil.copytree if (root / part).is_dir() else shutil.copy
        copy(root / part, tmp_path / part, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if copy is shutil.copytree else {}))
    code = "import __spark_entry__ as e; print(*e.queries()); assert not set(e.oracle_sql()) - set(e.queries())"
    env = {**os.environ, "PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
        names = done.stdout.split()
        assert len(names) >= 75 and "pipeline" not in names and not [n for n in names if n.startswith("op")]
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)




def test_tasks_of_a_batch_follow_its_rows(spark, monkeypatch):
    """However well rows are packed in a shuffle, no task lines up many more than the limit; the versions stay the same."""
    log = spark.range(400).selectExpr("CAST(id % 100 AS STRING) AS k", "CAST(id % 7 AS INT) AS v", "timestamp_seconds(id) AS _ingestion_timestamp")
    stored = log.limit(0).selectExpr("*", f"_ingestion_timestamp AS {H.START}", f"_ingestion_timestamp AS {H.END}", f"true AS {H.SHOWN}")
    expected = rows(H.maintain(stored, log, ["k"]))
    monkeypatch.setattr(H, "SORTED_ROWS", 20)
    made = H.maintain(stored, log, ["k"])
    assert "hashpartitioning(k" in made._jdf.queryExecution().executedPlan().toString()
    assert ", 20), REPARTITION_BY_NUM" in made._jdf.queryExecution().executedPlan().toString()
    assert rows(made) == expected

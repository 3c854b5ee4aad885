"""Landing and streaming flows run over the sample entities: CSV files out, the lake's flows in, the landed table back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.config import ENTITIES, KEYS, full_load_path, staging_path
from shoplake.functions.shape import publish
from shoplake.operators.history import END, START, scd2
from shoplake.plans.medallion import build
from shoplake.plans.refresh import refresh_daily_sales, refreshed_daily_sales
from shoplake.session import glob, remove, scratch_dir, set_times, shuffles_dropped
from shoplake.sources.lake import Lake, compact
from shoplake.sources.sample_views import bronze_entity, raw_entity, reader
from shoplake.streaming.checked import check_stream, clean_rows, quarantine
from shoplake.streaming.flows import compact_current, current, ingest, upsert
from shoplake.streaming.histories import compact_history, history, maintain_history


AS_OF = dt.date(2002, 1, 1)

#: How source files are written. A packed file is read by one task, so none gets more rows than one task reads in seconds.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "2000000"}


class Trial:
    """A lake in a new scratch folder, with the folders its source files arrive in."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.read = reader(spark, sf_dir)
        base = scratch_dir(spark, "flow")
        self.lake = Lake(spark, f"{base}/lake")
        self.full, self.landing = f"{base}/full", f"{base}/landing"
        self.aged: set[str] = set()

    def raw(self, entity: str) -> DataFrame:
        return raw_entity(self.read, entity)

    @staticmethod
    def _csv(df: DataFrame, path: str, mode: str) -> None:
        # Blanks at the ends of values are part of the sample's dirt.
        plain = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        with shuffles_dropped(df.sparkSession):
            df.write.mode(mode).options(**plain, **PACKED).csv(path)

    def send_full(self, entity: str, df: DataFrame) -> None:
        self._csv(df, full_load_path(self.full, entity), "overwrite")

    def send(self, entity: str, df: DataFrame) -> None:
        self._csv(df, staging_path(self.landing, entity), "append")

    def load_full(self, entity: str) -> None:
        """Backfill an entity, then drop its full file: a backfill that is marked as done never reads it again."""
        if self.lake.backfill(entity, self.full):
            remove(self.lake.spark, full_load_path(self.full, entity))

    def dated(self, path: str, at: dt.datetime) -> None:
        """Give the files under a path one time of change, but those that were given one before."""
        fresh = glob(self.lake.spark, f"{path.rstrip('/')}/part-*")
        for file in sorted(set(fresh) - self.aged):
            set_times(self.lake.spark, file, at.timestamp())
        self.aged.update(fresh)


def _landed(df: DataFrame) -> DataFrame:
    return publish(df.withColumnRenamed("_load_type", "load_type"))


def full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill products; the second call must not load them again."""
    t = Trial(spark, sf_dir)
    t.send_full("products", t.raw("products").drop("load_seq"))
    t.lake.backfill("products", t.full)
    t.lake.backfill("products", t.full)
    return _landed(t.lake.bronze("products"))


def full_load_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill every entity and count what arrived."""
    t = Trial(spark, sf_dir)
    counts = None
    for entity in ENTITIES:
        t.send_full(entity, t.raw(entity).drop("load_seq"))
        t.lake.backfill(entity, t.full)
        landed = t.lake.bronze(entity).groupBy(F.lit(entity).alias("entity"), F.col("_load_type").alias("load_type"))
        part = landed.agg(F.count(F.lit(1)).alias("row_count"))
        counts = part if counts is None else counts.unionByName(part)
    return counts


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in two deliveries, by date, with a run after each and one more with nothing new."""
    t = Trial(spark, sf_dir)
    orders, turn = t.raw("orders"), F.col("order_date") < F.lit("1998-01-01").cast("date")
    t.send("orders", orders.filter(turn))
    ingest(t.lake, t.landing, ["orders"])
    t.send("orders", orders.filter(~turn))
    ingest(t.lake, t.landing, ["orders"], files_per_batch=2)
    ingest(t.lake, t.landing, ["orders"])
    return _landed(t.lake.bronze("orders"))


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions whose later files have their columns in another order, one fewer, and a new one."""
    t = Trial(spark, sf_dir)
    sessions, early = t.raw("sessions"), F.col("traffic_source").isin("view", "click")
    t.send("sessions", sessions.filter(early))
    later = sessions.filter(~early).withColumn("referrer_code", F.concat(F.lit("ref-"), "customer_id"))
    t.send("sessions", later.select(*sorted(c for c in later.columns if c != "abandoned_cart_before")))
    ingest(t.lake, t.landing, ["sessions"])
    return _landed(t.lake.bronze("sessions"))


def fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk records: the first version backfilled, later ones streamed, one table out."""
    t = Trial(spark, sf_dir)
    records = t.raw("risk_support")
    t.send_full("risk_support", records.filter("load_seq = 0").drop("load_seq"))
    t.send("risk_support", records.filter("load_seq > 0").drop("load_seq"))
    t.lake.backfill("risk_support", t.full)
    ingest(t.lake, t.landing, ["risk_support"])
    return _landed(t.lake.bronze("risk_support"))


def upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments: backfill, then corrections by stream, with a compaction before and after."""
    t = Trial(spark, sf_dir)
    payments = t.raw("payments")
    t.send_full("payments", payments.filter("load_seq = 0").drop("load_seq"))
    t.lake.backfill("payments", t.full)
    compact_current(t.lake, "payments")
    t.send("payments", payments.filter("load_seq = 1").drop("load_seq"))
    ingest(t.lake, t.landing, ["payments"])
    upsert(t.lake, "payments")
    compact_current(t.lake, "payments")
    upsert(t.lake, "payments")
    return publish(current(t.lake, "payments"))


def versions_in_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products: both versions arrive as files of one batch, the second written later; their history keeps both."""
    t = Trial(spark, sf_dir)
    products = t.raw("products")
    for version in (0, 1):
        t.send("products", products.filter(F.col("load_seq") == version).drop("load_seq"))
    ingest(t.lake, t.landing, ["products"])
    history = scd2(t.lake.bronze("products"), KEYS["products"])
    return publish(history).select("product_id", "unit_price_usd", F.col(END).isNull().alias("is_current"))


def corrections_in_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments: records and their corrections arrive as files of one batch."""
    t = Trial(spark, sf_dir)
    payments = t.raw("payments")
    for version in (0, 1):
        t.send("payments", payments.filter(F.col("load_seq") == version).drop("load_seq"))
    ingest(t.lake, t.landing, ["payments"])
    upsert(t.lake, "payments")
    return publish(current(t.lake, "payments"))


def late_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments: corrections are streamed and folded into a snapshot before the older backfill is loaded."""
    t = Trial(spark, sf_dir)
    payments = t.raw("payments")
    t.send_full("payments", payments.filter("load_seq = 0").drop("load_seq"))
    t.send("payments", payments.filter("load_seq = 1").drop("load_seq"))
    ingest(t.lake, t.landing, ["payments"])
    upsert(t.lake, "payments")
    compact_current(t.lake, "payments")
    t.lake.backfill("payments", t.full)
    return publish(current(t.lake, "payments"))


DAY = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def equal_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments: the backfill and the corrections are files of one time of change, and the backfill is loaded last."""
    t = Trial(spark, sf_dir)
    payments = t.raw("payments")
    t.send("payments", payments.filter("load_seq = 1").drop("load_seq"))
    t.send_full("payments", payments.filter("load_seq = 0").drop("load_seq"))
    for path in (staging_path(t.landing, "payments"), full_load_path(t.full, "payments")):
        t.dated(path, DAY)
    ingest(t.lake, t.landing, ["payments"])
    upsert(t.lake, "payments")
    compact_current(t.lake, "payments")
    t.lake.backfill("payments", t.full)
    compact_current(t.lake, "payments")
    return publish(current(t.lake, "payments"))


def backfill_copied_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products: the backfill's file is a year younger than the corrections it comes before; state and history keep those."""
    t = Trial(spark, sf_dir)
    products = t.raw("products")
    t.send("products", products.filter("load_seq = 1").drop("load_seq"))
    t.send_full("products", products.filter("load_seq = 0").drop("load_seq"))
    t.dated(staging_path(t.landing, "products"), DAY)
    t.dated(full_load_path(t.full, "products"), DAY + dt.timedelta(365))
    ingest(t.lake, t.landing, ["products"])
    upsert(t.lake, "products")
    t.lake.backfill("products", t.full)
    found = current(t.lake, "products")
    open_ = scd2(t.lake.bronze("products"), KEYS["products"]).filter(F.col(END).isNull())
    both = found.select("product_id", "unit_price_usd").join(open_.select("product_id", F.col("unit_price_usd").alias("version_price_usd")), "product_id", "full")
    return publish(both)


def incremental_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk records: their second version arrives after the third, and the first once more, unchanged, in between. The history is kept
    up batch by batch and folded once."""
    t = Trial(spark, sf_dir)
    records = t.raw("risk_support")
    for version, day in ((0, 0), (2, 2), (0, 0), (1, 1)):
        t.send("risk_support", records.filter(F.col("load_seq") == version).drop("load_seq"))
        t.dated(staging_path(t.landing, "risk_support"), DAY + dt.timedelta(day))
        ingest(t.lake, t.landing, ["risk_support"])
        maintain_history(t.lake, "risk_support")
        if version == 2:
            compact_history(t.lake, "risk_support")
    kept = publish(history(t.lake, "risk_support"))
    return kept.withColumns({c: F.col(c).cast("date") for c in (START, END)})


def rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews, some with a rating that is no whole number: the column is NULL and the text is kept."""
    t = Trial(spark, sf_dir)
    turn, rating = F.col("product_id").cast("long") % 4, F.col("rating").cast("string")
    odd = F.when(turn == 0, F.concat(rating, F.lit(".5"))).when(turn == 1, F.lit("five")).otherwise(rating)
    t.send("reviews", t.raw("reviews").withColumn("rating", odd))
    ingest(t.lake, t.landing, ["reviews"])
    return t.lake.bronze("reviews").select("order_id", "product_id", "rating", F.col("_rescued").alias("rescued"))


# Rule names.
RULES = {
    "valid_total": ("total_price_usd > 0", "drop"),
    "has_customer": ("customer_id IS NOT NULL", "fail"),
    "valid_quantity": ("quantity > 0", "drop"),
    "small_discount": ("discount_percent <= 50", "warn"),
}


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in two deliveries, checked as they stream: every line with the mask and names of the rules it breaks."""
    t = Trial(spark, sf_dir)
    lines, turn = t.raw("order_items"), F.col("order_id").cast("long") % 2 == 0
    for part in (turn, ~turn):
        t.send("order_items", lines.filter(part))
        ingest(t.lake, t.landing, ["order_items"])
        check_stream(t.lake, "order_items", RULES)
    columns = ["order_id", "product_id", "quantity", "total_price_usd", F.col("_broken").alias("broken_mask")]
    held = quarantine(t.lake, "order_items", RULES).select(*columns, F.concat_ws(",", "broken_rules").alias("quarantined_for"))
    return publish(clean_rows(t.lake, "order_items").select(*columns, F.lit(None).cast("string").alias("quarantined_for")).unionByName(held))


def daily_sales_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales by change: the facts' first version lacks some orders, has others that are gone later, and others in another state."""
    t = Trial(spark, sf_dir)
    made: dict[str, DataFrame] = {}
    facts = build("fact_orders", lambda entity: bronze_entity(t.read, entity), AS_OF, made=made)
    t.lake._store("fact_orders", facts, 0)
    newest = t.lake.table("fact_orders")
    turn = F.pmod(F.xxhash64("order_id"), F.lit(10))
    # One pass: rows of turn 0 come later, those of turn 1 have a second one that is gone then, those of turn 2 are in another state.
    copies = F.explode(F.when(turn == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_gone")
    gone, changed = F.col("_gone") == 1, turn == 2
    other = {
        "customer_id": F.when(gone, F.lit("gone")).otherwise(F.col("customer_id")),
        "order_gross_amount": F.when(gone, F.col("order_gross_amount") + 1).otherwise(F.col("order_gross_amount")),
        "order_status": F.when(changed, F.lit("pending")).otherwise(F.col("order_status")),
        "fraud_risk_score": F.when(changed, F.lit(99.5)).otherwise(F.col("fraud_risk_score")),
        "order_date": F.when(changed, F.date_sub("order_date", 1)).otherwise(F.col("order_date")),
    }
    first = newest.filter(turn != 0).select("*", copies).withColumns(other).drop("_gone")
    t.lake._store("fact_orders", first, 0)
    refresh_daily_sales(t.lake)
    t.lake._store("fact_orders", newest, 0)
    refresh_daily_sales(t.lake)
    return publish(refreshed_daily_sales(t.lake))


def mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as 2,000 files with three headers: as contracted, in another order, and with a column more and one fewer."""
    t = Trial(spark, sf_dir)
    orders = t.raw("orders")
    turn = F.col("order_id").cast("long") % 3
    kinds = [orders, orders.select(*sorted(orders.columns)), orders.drop("city").withColumn("channel", F.concat(F.lit("ch"), turn))]
    for number, kind in enumerate(kinds):
        t.send("orders", kind.filter(turn == number).repartition(668 if number else 664))
    ingest(t.lake, t.landing, ["orders"])
    return _landed(t.lake.bronze("orders"))


#: Columns outside the contract, as SQL text over a session's number.
_EXTRA = {
    "hits": "CAST({n} % 1000 AS STRING)",
    "fee": "CAST({n} % 50 AS STRING) || '.' || CAST({n} % 7 AS STRING)",
    "ratio": "CAST({n} % 9 AS STRING) || 'e2'",
    "seen": "CAST(DATE '2024-01-01' + CAST({n} % 90 AS INT) AS STRING)",
    "badge": "'00' || CAST({n} % 10 AS STRING)",
}


def _with_extra(t: Trial, columns: dict[str, str]) -> DataFrame:
    number = "CAST(session_id AS BIGINT)"
    return t.raw("sessions").select("session_id", *(F.expr(sql.format(n=number)).alias(name) for name, sql in columns.items()))


def _typed(t: Trial) -> DataFrame:
    """The inferred columns, each with the name of its type."""
    found = t.lake.inferred("sessions")
    names = t.lake.extra_columns("sessions")
    return publish(found.select("session_id", *names, *(F.expr(f"typeof({n})").alias(f"{n}_type") for n in names)))


def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with five columns that no contract names, in two deliveries of which the first leaves one blank."""
    t = Trial(spark, sf_dir)
    rows, early = _with_extra(t, _EXTRA), F.col("session_id").cast("long") % 2 == 0
    t.send("sessions", rows.filter(early).withColumn("seen", F.lit(None).cast("string")))
    ingest(t.lake, t.landing, ["sessions"])
    t.send("sessions", rows.filter(~early))
    ingest(t.lake, t.landing, ["sessions"])
    return _typed(t)


def type_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions whose second delivery has wider values: halves among whole numbers, words among decimals."""
    t = Trial(spark, sf_dir)
    rows, early = _with_extra(t, {n: _EXTRA[n] for n in ("hits", "fee")}), F.col("session_id").cast("long") % 2 == 0
    t.send("sessions", rows.filter(early))
    ingest(t.lake, t.landing, ["sessions"])
    t.send("sessions", rows.filter(~early).withColumns({"hits": F.concat("hits", F.lit(".5")), "fee": F.concat(F.lit("n/a "), "fee")}))
    ingest(t.lake, t.landing, ["sessions"])
    return _typed(t)


def bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk records in four batches: three are folded in two steps, the last arrives after them."""
    t = Trial(spark, sf_dir)
    records, turn = t.raw("risk_support").drop("load_seq"), F.pmod(F.xxhash64("risk_id"), F.lit(4))
    for number in range(4):
        t.send("risk_support", records.filter(turn == number).repartition(8))
        ingest(t.lake, t.landing, ["risk_support"])
        if number in (1, 2):
            t.lake.compact_bronze("risk_support")
    return _landed(t.lake.bronze("risk_support"))


def compacted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "compact")
    raw_entity(reader(spark, sf_dir), "orders").repartition(32).write.parquet(f"{base}/small")
    compact(spark, f"{base}/small", f"{base}/even", "order_date")
    return spark.read.parquet(f"{base}/even")


def many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arriving as 700 files at once, as many as one entity's folder holds."""
    t = Trial(spark, sf_dir)
    t.send("orders", t.raw("orders").repartition(700))
    ingest(t.lake, t.landing, ["orders"])
    return _landed(t.lake.bronze("orders"))


def _deliver(t: Trial, entities: Iterable[str]) -> None:
    """First versions as backfill, later ones as incremental files."""
    with shuffles_dropped(t.lake.spark):
        for entity in entities:
            records = t.raw(entity)
            versioned = "load_seq" in records.columns
            t.send_full(entity, records.filter("load_seq = 0").drop("load_seq") if versioned else records)
            if versioned:
                t.send(entity, records.filter("load_seq > 0").drop("load_seq"))
            t.load_full(entity)
        ingest(t.lake, t.landing, entities)


def stored_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to daily sales with every layer stored in between."""
    t, entities = Trial(spark, sf_dir), ("orders", "order_items", "payments", "shipping")
    _deliver(t, entities)
    t.lake.materialize([*(f"{e}_silver" for e in entities), "fact_orders", "agg_daily_sales"], AS_OF)
    return publish(t.lake.table("agg_daily_sales"))


def stored_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline: all entities from files through every stored table."""
    t = Trial(spark, sf_dir)
    _deliver(t, ENTITIES)
    t.lake.materialize(as_of=AS_OF)
    return publish(t.lake.table("agg_customer_metrics"))


QUERIES = {
    "bronze_full_load": full_load,
    "bronze_full_load_all": full_load_all,
    "bronze_stream": stream,
    "bronze_stream_700_files": many_files,
    "bronze_schema_evolution": schema_evolution,
    "bronze_fan_in": fan_in,
    "bronze_rescued": rescued,
    "bronze_mixed_headers": mixed_headers,
    "bronze_inferred_types": inferred_types,
    "bronze_type_widened": type_widened,
    "bronze_compacted": bronze_compacted,
    "scd1_stream": upsert_stream,
    "scd1_stream_one_batch": corrections_in_one_batch,
    "scd1_stream_late_backfill": late_backfill,
    "scd1_equal_times": equal_times,
    "scd1_backfill_copied_later": backfill_copied_later,
    "scd2_stream": versions_in_one_batch,
    "scd2_incremental": incremental_history,
    "compacted_orders": compacted_orders,
    "expect_stream_quarantine": stream_quarantine,
    "agg_daily_sales_refreshed": daily_sales_refreshed,
    "stored_daily_sales": stored_daily_sales,
    "stored_lake": stored_lake,
}

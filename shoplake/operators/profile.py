"""Profiling jobs. Each reads its table once, however many columns or rules it covers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions.rules import proper_case

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def string_columns(df: DataFrame) -> list[str]:
    return [name for name, dtype in df.dtypes if dtype == "string"]


def _tall(df: DataFrame, aggregates: Mapping[str, Column], label: str, value: str) -> DataFrame:
    """Whole-table aggregates as one row each."""
    wide = df.agg(*(agg.alias(f"_a{i}") for i, agg in enumerate(aggregates.values())))
    lines = [F.struct(F.lit(n).alias(label), F.col(f"_a{i}").alias(value)) for i, n in enumerate(aggregates)]
    return wide.select(F.inline(F.array(*lines)))


def null_counts(df: DataFrame) -> DataFrame:
    return _tall(df, {c: F.count_if(_quoted(c).isNull()) for c in df.columns}, "column_name", "null_rows")


def sentinel_counts(df: DataFrame, sentinel: str = "-") -> DataFrame:
    """How often each string column holds a placeholder for a missing value."""
    return _tall(df, {c: F.count_if(_quoted(c) == sentinel) for c in string_columns(df)}, "column_name", "sentinel_rows")


def filled_columns(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Row count and non-NULL count per column, from one job."""
    row = df.agg(F.count(F.lit(1)), *(F.count(_quoted(c)) for c in df.columns)).first()
    return row[0], dict(zip(df.columns, row[1:]))


def keep_filled(df: DataFrame, share_above: float) -> DataFrame:
    """Drop columns unless more than the given share of their rows is filled."""
    rows, filled = filled_columns(df)
    return df.select(*(_quoted(c) for c in df.columns if not rows or filled[c] > share_above * rows))


def drop_mostly_null(df: DataFrame, null_share: float = 0.95) -> DataFrame:
    """Drop columns whose share of NULLs reaches the limit."""
    rows, filled = filled_columns(df)
    return df.select(*(_quoted(c) for c in df.columns if not rows or (rows - filled[c]) / rows < null_share))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def duplicate_rows(df: DataFrame) -> DataFrame:
    return duplicate_keys(df, df.columns)


def most_frequent_first(counts: DataFrame) -> DataFrame:
    rest = [F.col(c) for c in counts.columns if c != "row_count"]
    return counts.orderBy(F.col("row_count").desc(), *rest)


def key_cardinality(df: DataFrame, key: str) -> DataFrame:
    """Rows against distinct values; NULL counts as one value, as it does in a distinct listing."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    )


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """How many rows meet each predicate."""
    return _tall(df, {name: F.count_if(rule) for name, rule in rules.items()}, "rule", "row_count")


def rule_rows(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """The rows that meet any of the rules, with the names of those they meet, in order, as ``broken_rules``."""
    met = {name: F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(False)) for name, rule in rules.items()}
    names = F.concat_ws(",", *(F.when(rule, F.lit(name)) for name, rule in met.items()))
    return df.withColumn("broken_rules", names).filter(F.col("broken_rules") != "")


def column_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of each column, as one row per column."""
    types = dict(df.dtypes)
    columns = list(columns or df.columns)
    aggregates = []
    for i, name in enumerate(columns):
        c = _quoted(name)
        number = c.cast("double") if types[name].startswith(NUMERIC) else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if types[name].startswith(NUMERIC) else c.cast("string")
        aggregates += [
            F.count(c).alias(f"_n{i}"),
            F.avg(number).alias(f"_avg{i}"),
            F.stddev_samp(number).alias(f"_dev{i}"),
            F.min(number).alias(f"_lo{i}"),
            F.max(number).alias(f"_hi{i}"),
            F.min(text).alias(f"_first{i}"),
            F.max(text).alias(f"_last{i}"),
        ]
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"_n{i}").alias("non_null_rows"),
            F.col(f"_avg{i}").alias("mean"),
            F.col(f"_dev{i}").alias("stddev"),
            F.col(f"_lo{i}").alias("min_number"),
            F.col(f"_hi{i}").alias("max_number"),
            F.col(f"_first{i}").alias("min_text"),
            F.col(f"_last{i}").alias("max_text"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*lines)))


def domain_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several columns with their counts, in one pass."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), _quoted(c).cast("string").alias("value")) for c in columns))
    return df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def domain_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))


def lookup(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows of one key."""
    return df.filter(F.col(column) == value)


def any_filled(df: DataFrame, column: str) -> bool:
    """Whether any row has a value; stops at the first one found."""
    return not df.filter(_quoted(column).isNotNull()).isEmpty()


def first_filled(df: DataFrame, column: str) -> DataFrame:
    """``any_filled`` as a one-row table."""
    return df.filter(_quoted(column).isNotNull()).limit(1).agg((F.count(F.lit(1)) > 0).alias("key_exists"))


def preview(df: DataFrame, rows: int = 40) -> DataFrame:
    return df.limit(rows)


# --- entity audits --------------------------------------------------------------------------------------------------
def amount_checks(items: DataFrame, less_discount: bool = False) -> DataFrame:
    """Items next to what their amounts should be."""
    expected = F.col("quantity") * F.col("unit_price_usd")
    if less_discount:
        expected = expected - F.col("discount_amount_usd")
    return items.select(
        "*",
        expected.alias("calc_total"),
        (F.col("total_price_usd") - F.col("cost_usd")).alias("calc_profit"),
        F.try_divide(F.col("profit_usd") * 100, F.col("total_price_usd")).alias("calc_margin"),
    )


def amount_audit(items: DataFrame, less_discount: bool = False) -> DataFrame:
    """Rows whose stored total, profit or margin differs from the recomputed one by more than a cent (0.1 points)."""

    def off(stored: str, computed: str, tolerance: str) -> Column:
        return F.count_if(F.abs(F.col(stored) - F.col(computed)) > F.lit(tolerance).cast("decimal(4,2)"))

    # Names of the audit's counts.
    return amount_checks(items, less_discount).agg(
        off("total_price_usd", "calc_total", "0.01").alias("total_price_mismatch"),
        off("profit_usd", "calc_profit", "0.01").alias("profit_mismatch"),
        off("profit_margin_percent", "calc_margin", "0.1").alias("margin_mismatch"),
    )


def amount_repair(items: DataFrame) -> DataFrame:
    """Recompute total, then profit from that total, then margin from that profit."""
    total = F.col("quantity") * F.col("unit_price_usd") - F.col("discount_amount_usd")
    profit = total - F.col("cost_usd")
    return items.withColumns(
        {
            "total_price_usd": total,
            "profit_usd": profit,
            "profit_margin_percent": F.try_divide(profit * 100, total),
        }
    )


def coupon_audit(orders: DataFrame) -> DataFrame:
    """Orders whose coupon flag (0/1) and code contradict each other."""
    code, used = F.col("coupon_code"), F.col("coupon_used")
    problem = F.when((used == 0) & code.isNotNull(), "code_without_use").when((used == 1) & code.isNull(), "use_without_code")
    return orders.withColumn("violation", problem).filter(F.col("violation").isNotNull())


def future_dates(df: DataFrame, column: str, as_of: Column) -> DataFrame:
    return df.filter(F.col(column) > as_of)


def with_proper_case(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: proper_case(F.col(c)) for c in columns})

"""Expectations: named row predicates that warn, drop or fail."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


#: What happens to a row that breaks a rule: it is counted, left out, or stops the job.
WARN, DROP, FAIL = "warn", "drop", "fail"
ACTIONS = (WARN, DROP, FAIL)


class ExpectationError(ValueError):
    """Rows break a rule that must hold. ``failed_rows`` has their number per rule."""

    def __init__(self, failed_rows: Mapping[str, int]):
        super().__init__("; ".join(f"{rule}: {n} rows" for rule, n in failed_rows.items()))
        self.failed_rows = dict(failed_rows)


def _holds(rule: Column | str) -> Column:
    """An unknown outcome counts as broken."""
    return F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(False))


def _counts(rules: Mapping[str, Column | str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("_rows"), *(F.count_if(~_holds(rule)).alias(name) for name, rule in rules.items())]


def violations(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """Per rule: rows seen, rows passed, rows failed. One pass for all rules."""
    lines = [
        F.struct(
            F.lit(name).alias("expectation"),
            F.col("_rows").alias("total_rows"),
            (F.col("_rows") - F.col(f"`{name}`")).alias("passed_rows"),
            F.col(f"`{name}`").alias("failed_rows"),
        )
        for name in rules
    ]
    return df.agg(*_counts(rules)).select(F.inline(F.array(*lines)))


def expect(df: DataFrame, rules: Mapping[str, Column | str]) -> tuple[DataFrame, DataFrame]:
    """Warn: every row stays; the second frame counts the violations."""
    return df, violations(df, rules)


def expect_or_drop(df: DataFrame, rules: Mapping[str, Column | str]) -> tuple[DataFrame, DataFrame]:
    """Drop: only rows that meet all rules stay; the second frame counts the violations."""
    return df.filter(reduce(Column.__and__, map(_holds, rules.values()))), violations(df, rules)


def expect_or_fail(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """Fail: counts first, and raises before any row is handed on."""
    broken = {r["expectation"]: r["failed_rows"] for r in violations(df, rules).collect() if r["failed_rows"]}
    if broken:
        raise ExpectationError(broken)
    return df


def enforce(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """Fail inside the plan: the job that reads a breaking row stops. Needs no pass of its own."""
    for name, rule in rules.items():
        df = df.filter(F.assert_true(_holds(rule), F.lit(f"expectation {name} failed")).isNull())
    return df


def observe(df: DataFrame, rules: Mapping[str, Column | str], name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Warn without a pass of its own: the counts are ready in ``observation.get`` once the frame is written."""
    seen = Observation(name)
    return df.observe(seen, *_counts(rules)), seen


def broken_mask(rules: Mapping[str, Column | str]) -> Column:
    """One bit for each rule that a row breaks, in the order of the rules; up to 62 of them."""
    bits = [F.when(_holds(rule), 0).otherwise(1 << k).cast("long") for k, rule in enumerate(rules.values())]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long"))


def apply(df: DataFrame, rules: Mapping[str, str | tuple[str, str]], name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Rules with actions in one plan: all are counted on every row, rows that break a ``drop`` rule are left out, and one that breaks a
    ``fail`` rule stops the job that reads it. A rule without an action warns."""
    given = {n: (rule, WARN) if isinstance(rule, str) else rule for n, rule in rules.items()}
    if unknown := {does for _, does in given.values()} - set(ACTIONS):
        raise ValueError(f"unknown actions {sorted(unknown)}")
    df, seen = observe(df, {n: sql for n, (sql, _) in given.items()}, name)
    df = enforce(df, {n: sql for n, (sql, does) in given.items() if does == FAIL})
    dropping = [_holds(sql) for sql, does in given.values() if does == DROP]
    return df.filter(reduce(Column.__and__, dropping)) if dropping else df, seen

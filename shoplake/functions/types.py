"""Types of text columns, as states that can be merged.

A state counts how many values of a column fit each type and keeps the digits they need. States of parts of a table add up to the state
of the whole, in any order, and more values only ever widen the type: nothing, whole numbers, decimals, doubles, text; dates,
instants, text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# How numbers and dates are written. A number with leading zeros is a code, and stays text.
WHOLE = r"^[+-]?(0|[1-9][0-9]*)$"
DECIMAL = r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?$"
DOUBLE = r"^[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"

#: Fields of a state that add up, and those of which the larger counts.
COUNTS, SIZES = ("filled", "whole", "decimals", "doubles", "dates", "instants"), ("digits", "scale")
STATE = ", ".join([*(f"{c} long" for c in COUNTS), *(f"{c} int" for c in SIZES)])


def type_state(column: str) -> Column:
    """Aggregate: the state of a text column, as a struct. NULL and blank values tell nothing."""
    text = F.trim(F.col(column))
    decimal = text.rlike(DECIMAL)
    digits = F.length(F.regexp_extract(text, r"^[+-]?([0-9]+)", 1))
    scale = F.length(F.regexp_extract(text, r"\.([0-9]+)$", 1))

    def fits(pattern: str, kind: str) -> Column:
        return text.rlike(pattern) & text.try_cast(kind).isNotNull()

    counts = (text != "", text.rlike(WHOLE), decimal, text.rlike(DOUBLE), fits(DATE, "date"), fits(INSTANT, "timestamp"))
    fields = [F.count_if(test).alias(name) for name, test in zip(COUNTS, counts, strict=True)]
    sizes = [F.coalesce(F.max(F.when(decimal, size)), F.lit(0)).alias(name) for name, size in zip(SIZES, (digits, scale), strict=True)]
    return F.struct(*fields, *sizes)


def merged() -> list[Column]:
    """Aggregates that merge states held as columns."""
    return [F.sum(c).alias(c) for c in COUNTS] + [F.max(c).alias(c) for c in SIZES]


def type_of(state: dict[str, int | None]) -> str:
    """The narrowest type that holds every value a state has seen; text where it has seen none."""
    filled, digits, scale = state["filled"], state["digits"] or 0, state["scale"] or 0
    if not filled:
        return "string"
    if state["whole"] == filled and digits <= 38:
        return "int" if digits <= 9 else "bigint" if digits <= 18 else f"decimal({digits},0)"
    if state["decimals"] == filled and digits + scale <= 38:
        return f"decimal({digits + scale},{scale})"
    if state["doubles"] == filled:
        return "double"
    if state["dates"] == filled:
        return "date"
    return "timestamp" if state["instants"] == filled else "string"


def states(columns: Sequence[str]) -> Column:
    """Aggregate: an array of the states of columns, each with its ``column_name``."""
    return F.array(*(F.struct(F.lit(c).alias("column_name"), type_state(c).alias("state")) for c in columns))

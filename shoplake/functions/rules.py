"""Column rules: every function takes a Column and returns a Column, all built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# --- text -----------------------------------------------------------------------------------------------------------
def tidy(c: Column) -> Column:
    """Trimmed lower case; NULL stays NULL."""
    return F.lower(F.trim(c))


def tidy_or_null(c: Column) -> Column:
    """Trimmed lower case, with blank text turned into NULL."""
    return F.nullif(tidy(c), F.lit(""))


def proper_case(c: Column) -> Column:
    """Trimmed, first letter of each word in upper case."""
    return F.initcap(F.trim(c))


def one_of(c: Column, domain: Iterable[str], default: str) -> Column:
    """The value where it belongs to ``domain``, else ``default`` (also for NULL)."""
    return F.when(c.isin(*domain), c).otherwise(F.lit(default))


def gender_bucket(c: Column) -> Column:
    """male / female / other, and unknown for NULL."""
    return F.when(c.isNull(), F.lit("unknown")).otherwise(one_of(c, ("male", "female"), "other"))


def composite_key(*parts: Column) -> Column:
    """Parts joined by an underscore; a NULL part is left out."""
    return F.concat_ws("_", *(p.cast("string") for p in parts))


# --- numbers --------------------------------------------------------------------------------------------------------
def at_least(c: Column, low: float) -> Column:
    """NULL where the value is below ``low``."""
    return F.when(c >= low, c)


def above(c: Column, low: float) -> Column:
    """NULL where the value is not strictly above ``low``."""
    return F.when(c > low, c)


def within(c: Column, low: float, high: float) -> Column:
    """NULL where the value is outside the closed range."""
    return F.when(c.between(low, high), c)


def not_under(c: Column, low: int) -> Column:
    """Raise values below ``low`` to ``low``; NULL stays NULL."""
    return F.when(c < low, F.lit(low)).otherwise(c)


def null_or_within(c: Column, low: float, high: float) -> Column:
    """Row predicate: unknown values pass, known values must be inside the closed range."""
    return c.isNull() | c.between(low, high)


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Rounded quotient, NULL on a zero denominator."""
    return F.round(F.try_divide(numerator, denominator), digits)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two digits. Multiplies first so that decimal inputs lose no digit."""
    return ratio(part * F.lit(100), whole)


# --- flags ----------------------------------------------------------------------------------------------------------
def flag(predicate: Column) -> Column:
    """1 where the predicate holds, 0 where it is false or unknown."""
    return F.coalesce(predicate.cast("int"), F.lit(0))


def yes_flag(c: Column) -> Column:
    return flag(tidy(c) == "yes")


# --- bands ----------------------------------------------------------------------------------------------------------
def _cascade(tests: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    (first, label), *rest = tests
    chain = F.when(first, label)
    for test, name in rest:
        chain = chain.when(test, name)
    return chain.otherwise(F.lit(otherwise))


def band_below(c: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose limit the value is below; NULL and the rest take ``otherwise``."""
    return _cascade([(c < limit, label) for limit, label in steps], otherwise)


def band_up_to(c: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose limit the value does not exceed; NULL and the rest take ``otherwise``."""
    return _cascade([(c <= limit, label) for limit, label in steps], otherwise)


def band_from(c: Column, steps: Sequence[tuple[float, str]], otherwise: str, known: str | None = None) -> Column:
    """First label whose floor the value reaches. ``known`` labels other non-NULL values, ``otherwise`` the rest."""
    tests = [(c >= floor, label) for floor, label in steps]
    if known is not None:
        tests.append((c.isNotNull(), known))
    return _cascade(tests, otherwise)


def band_equal(c: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    return _cascade([(c == value, label) for value, label in steps], otherwise)

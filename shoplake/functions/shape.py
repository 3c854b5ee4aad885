"""Bring a table into a declared shape, or into a published one."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoplake.config import CONTRACTS, METADATA


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def typed(name: str, source: str, target: str) -> str:
    """SQL text of a cast that turns malformed values into NULL. Whole numbers may be written as ``12.0``; a fraction in a
    column of whole numbers is malformed, never cut off."""
    if source == target:
        return quoted(name)
    if target == "int" and source != "bigint":
        number = f"try_cast({quoted(name)} AS double)"
        whole = f"IF({number} = floor({number}), try_cast({number} AS int), NULL)"
        # Plain whole numbers, nearly all texts, are parsed once.
        return f"coalesce(try_cast({quoted(name)} AS int), {whole})" if source == "string" else whole
    return f"try_cast({quoted(name)} AS {target})"


def lossy(name: str, made: str, target: str) -> str:
    """SQL text of whether ``typed`` changed or dropped what a text column holds, given the column ``made`` that holds its result.

    A plain number with no more digits behind the point than the type has is kept as it is, so only others are compared digit by digit.
    """
    text, value, changed = quoted(name), quoted(made), "FALSE"
    if target.startswith(("int", "decimal")):
        scale = int(target.rstrip(")").split(",")[1]) if target.startswith("decimal") else 0
        point = f"instr({text}, '.')"
        plain = f"NOT contains({text}, 'e') AND NOT contains({text}, 'E') AND ({point} = 0 OR length({text}) - {point} <= {min(scale, 12)})"
        changed = f"NOT ({plain}) AND coalesce(try_cast({text} AS decimal(38,12)) <> CAST({value} AS decimal(38,12)), FALSE)"
    return f"(({value} IS NULL OR {changed}) AND trim({text}) <> '')"


def conform(df: DataFrame, entity: str, metadata: bool = True) -> DataFrame:
    """Select an entity's contract columns by name, cast to their types; absent ones become typed NULLs."""
    wanted = {**CONTRACTS[entity], **(METADATA if metadata else {})}
    have = {name.lower(): dtype for name, dtype in df.dtypes}
    return df.selectExpr(
        *(
            f"{typed(name, have[name], dtype) if name in have else f'CAST(NULL AS {dtype})'} AS {quoted(name)}"
            for name, dtype in wanted.items()
        )
    )


def publish(df: DataFrame) -> DataFrame:
    """Reader-facing form: no load metadata, decimals as doubles."""
    return df.selectExpr(
        *(
            f"CAST({quoted(name)} AS double) AS {quoted(name)}" if dtype.startswith("decimal") else quoted(name)
            for name, dtype in df.dtypes
            if name not in METADATA
        )
    )

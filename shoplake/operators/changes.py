"""Row-level difference between two snapshots of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per inserted, deleted or updated key, with ``change_type`` and the new (deleted: the old) values.

    Both snapshots meet in one aggregation by key, at about the cost of a join: keys are unique in a snapshot, so nothing shrinks
    before the shuffle. A key that occurs twice in a snapshot is an error, raised while the job runs.
    """
    values = [c for c in new.columns if c not in keys]
    tagged = old.select(*new.columns, F.lit(False).alias("_new")).unionByName(
        new.select("*", F.lit(True).alias("_new"))
    )
    row = F.struct(*values)
    grouped = tagged.groupBy(*keys).agg(
        F.max(F.when(~F.col("_new"), row)).alias("_before"),
        F.max(F.when(F.col("_new"), row)).alias("_after"),
        F.count_if(~F.col("_new")).alias("_olds"),
        F.count_if(F.col("_new")).alias("_news"),
    )
    kind = (
        F.when((F.col("_olds") > 1) | (F.col("_news") > 1), F.raise_error(F.lit("change_feed: key repeats in a snapshot")).cast("string"))
        .when(F.col("_olds") == 0, F.lit("insert"))
        .when(F.col("_news") == 0, F.lit("delete"))
        .when(~F.col("_before").eqNullSafe(F.col("_after")), F.lit("update"))
    )
    current = F.coalesce("_after", "_before")
    return (
        grouped.select(*keys, kind.alias("change_type"), current.alias("_row"))
        .filter(F.col("change_type").isNotNull())
        .select(*keys, "change_type", *(F.col(f"_row.{c}").alias(c) for c in values))
    )

"""Run registered queries next to their SQL counterparts and compare rows.

Usage: python tests/compare.py [sf-folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same rows (any order), else what differs."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns: spark-only {set(df.columns) - set(names)}, sql-only {set(names) - set(df.columns)}"
    expected = _rows(names, found.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if actual != expected:
        return (
            f"rows {sum(actual.values())} vs {sum(expected.values())}; columns {sorted(names)}\n"
            f"  spark-only {list((actual - expected).items())[:2]}\n  sql-only   {list((expected - actual).items())[:2]}"
        )
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from shoplake.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    picked = sys.argv[2:]
    spark = session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if picked and name not in picked:
            continue
        start = time.time()
        try:
            if name in sqls:
                wrong = difference(query(spark, sf_dir), con, sqls[name])
            else:
                wrong = f"no sql; {query(spark, sf_dir).count()} rows"
        except Exception as error:
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += wrong is not None
        print(f"{'ok  ' if wrong is None else 'BAD '} {name} {time.time() - start:.2f}s {wrong or ''}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()

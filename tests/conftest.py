from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shoplake.operators import skew
from shoplake.session import session
from shoplake.sources.lake import Lake

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    built = session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    built.sparkContext.setLogLevel("OFF")
    return built


@pytest.fixture
def heavy(spark):
    """Treat any key with more than a hundredth of the rows as heavy, however small the table."""
    spark.conf.set(skew.MIN_ROWS, "1")
    spark.conf.set(skew.SHARE, "0.01")
    spark.conf.set(skew.WAYS, "4")
    yield
    for name in (skew.MIN_ROWS, skew.SHARE, skew.WAYS):
        spark.conf.unset(name)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def rows(df):
    """Rows as sorted text, for order-free comparison."""
    columns = sorted(df.columns)
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())

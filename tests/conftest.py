from __future__ import annotations

import uuid

import pytest
from pyspark.sql import SparkSession

from stratalake.plans.lake import Lake
from stratalake.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("stratalake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    """A lake whose schemas no other test uses."""
    lake = Lake(
        spark,
        landing=str(tmp_path / "landing"),
        prefix=f"t{uuid.uuid4().hex[:8]}_",
        location=str(tmp_path / "tables"),
    )
    lake.create_schemas()
    return lake


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)

"""Query registry and table access."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stratalake.plans.lake import Lake
from stratalake.session import configure
from stratalake.storage import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None, name: str | None = None):
    """Register a query (under its function name), with the SQL it must agree with."""

    def register(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        key = name or function.__name__
        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql
        return run

    return register


_SCHEMAS: dict[str, StructType] = {}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table.  Its schema is read once per process: each look is a Spark job."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def new_lake(spark: SparkSession, label: str) -> Lake:
    """A lake with schemas of its own, stored in the shared scratch folder."""
    folder = scratch_dir(spark, label)
    lake = Lake(
        spark,
        landing=f"{folder}/landing",
        prefix=f"{label}_{uuid.uuid4().hex[:8]}_",
        location=f"{folder}/tables",
    )
    lake.create_schemas()
    return lake

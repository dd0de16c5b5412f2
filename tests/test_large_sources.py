"""Sources that are too large to broadcast: the same tables, with fewer copies and shuffles."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stratalake.plans.backlog import (
    batch_losses,
    cleaned_batches,
    last_cleaned,
    last_writers,
    load_silver_backlog,
    run_backlog,
)
from stratalake.plans.datasets import RESULTS
from stratalake.plans.incremental import load_bronze_batch, load_silver_batch, run_batch
from stratalake.sinks import TableLayout, overwrite, tables, upsert
from tests.conftest import rows
from tests.test_backlog import audits, awkward_batches, batches, gold, silver


@contextmanager
def everything_large(spark):
    """Spark plans to broadcast nothing, as if all inputs were large."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def recorded(monkeypatch):
    plans, write = [], tables._write_version

    def recording(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args)

    monkeypatch.setattr(tables, "_write_version", recording)
    return plans


@pytest.mark.parametrize("make", [batches, awkward_batches])
def test_large_batches_give_the_same_tables(lake, make):
    make(lake)
    pending = ["2025-01", "2025-02", "2025-03"]
    lakes = [replace(lake, prefix=lake.prefix + name, location=lake.location + name) for name in ("one_", "all_")]
    for batch_id in pending:
        run_batch(lake, batch_id)
    with everything_large(lake.spark):
        for batch_id in pending:
            run_batch(lakes[0], batch_id)
        assert run_backlog(lakes[1]) == pending
    for other in lakes:
        assert gold(other) == gold(lake) and silver(other) == silver(lake) and audits(other) == audits(lake)


def test_a_large_batch_is_shuffled_once_with_its_target(lake, monkeypatch):
    """Cleaning and merging share one shuffle of the batch; the target has one, and the files none."""
    batches(lake)
    with everything_large(lake.spark):
        for batch_id in ("2025-01", "2025-02"):
            load_bronze_batch(lake, RESULTS, batch_id)
            plans = recorded(monkeypatch)
            load_silver_batch(lake, RESULTS, batch_id)
            assert len(plans) == 1 and plans[0].count("Exchange") == (1 if batch_id == "2025-01" else 2), plans


def test_a_large_full_write_stays_where_it_is_unless_it_reaches_many_partitions(lake, monkeypatch):
    spark, layout = lake.spark, TableLayout(partition_by="k")
    ids = spark.range(100).selectExpr("cast(id % 20 AS int) AS k", "id AS v")
    plans = recorded(monkeypatch)
    for reached in (None, 20, 16):
        overwrite(ids, lake.name("gold", f"t{reached}"), layout, partitions=reached)
        assert rows(spark.table(lake.name("gold", f"t{reached}")), "v") == rows(ids, "v")
    assert [plan.count("Exchange") for plan in plans] == [1, 1, 0]


def test_a_direct_source_may_repeat_or_lack_keys(lake):
    spark, name = lake.spark, lake.name("silver", "t")
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "s int, k string, v int")
    overwrite(old, name, TableLayout(partition_by="s"))
    new = spark.createDataFrame([(1, "a", 2), (1, None, 3), (3, "c", 4), (None, "d", 5)], old.schema)
    direct = {"keys": ["s", "k"], "update": ["v"], "small_source": False, "reaching": new}
    upsert(new, name, **direct)
    want = [(1, "a", 2), (1, None, 3), (2, "b", 1), (3, "c", 4), (None, "d", 5)]
    assert rows(spark.table(name), "s", "k", "v") == sorted(want, key=repr)
    twice = new.union(new)
    with pytest.raises(ValueError, match="a"):
        upsert(twice, name, **direct)
    assert spark.table(name).agg(F.sum("v")).first()[0] == 15


def test_the_last_cleaned_row_is_the_one_of_the_last_batch(lake, monkeypatch):
    """One shuffle of whole rows for a backlog, however many batches it has."""
    batches(lake)
    pending = ["2025-01", "2025-02", "2025-03"]
    with everything_large(lake.spark):
        for batch_id in pending:
            load_bronze_batch(lake, RESULTS, batch_id)
        plans = recorded(monkeypatch)
        load_silver_backlog(lake, RESULTS, pending)
        assert len(plans) == 1 and plans[0].count("Exchange") == 1, plans
    bronze = lake.table("bronze", "results")
    cleaned = cleaned_batches(lake, RESULTS, pending)
    want = last_writers(cleaned, RESULTS.spec.keys)
    assert rows(last_cleaned(bronze, RESULTS.spec), *want.columns) == rows(want)
    assert batch_losses(bronze.limit(0), RESULTS.spec, ["x"])["x"]["rows_in"] == 0

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stratalake.operators import ConformSpec, any_per_key, conform, first_per_key, removed_rows
from stratalake.operators.conform import rename, shape
from stratalake.plans.datasets import CIRCUITS, DATASETS, DRIVERS, RACES, RESULTS, landing_schema
from tests.conftest import rows

SPEC = ConformSpec(
    keys=("id",), checked_keys=(), columns=("Id", "Name"), renames={"Id": "id", "Name": "name"},
    title=("name",),
)


def test_rename_rejects_an_unknown_column(spark):
    with pytest.raises(ValueError, match="missing columns"):
        rename(spark.range(1), {"nope": "x"})


def test_shape_keeps_lineage_columns(spark):
    df = spark.createDataFrame([(1, "a", "u", "f", "b1")], "Id int, Name string, url string, source_file string, batch_id string")
    assert shape(df, SPEC).columns == ["id", "name", "source_file", "batch_id"]


def test_conform_rejects_null_keys_and_duplicates(spark):
    df = spark.createDataFrame(
        [(1, "b c"), (1, "A C"), (2, "x"), (None, "n"), (None, "m")], "Id int, Name string"
    )
    assert rows(conform(df, SPEC)) == [(1, "A C"), (2, "X")]
    relaxed = conform(df, SPEC, strict_keys=False)
    assert rows(relaxed) == [(1, "A C"), (2, "X"), (None, "M")]
    assert sorted(r.id or 0 for r in conform(df, SPEC, arbitrary=True).collect()) == [1, 2]


def test_first_per_key_takes_the_given_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (None, 1, "c"), (None, 2, "d")], "k int, o int, v string")
    latest = first_per_key(df, ["k"], [F.col("o").desc()])
    assert rows(latest, "k", "v") == [(1, "b"), (None, "d")]
    assert any_per_key(df, ["k"]).count() == 2


def test_first_per_key_cuts_groups_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS o")
    plan = first_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle


def test_removed_rows_counts_both_causes(spark):
    df = spark.createDataFrame(
        [(1, 1), (1, 1), (1, 2), (None, 1), (1, None), (None, None), (None, 1)], "a int, b int"
    )
    assert rows(removed_rows(df, ["a", "b"])) == [(7, 4, 1, 5, 2)]
    assert rows(removed_rows(df.limit(0), ["a", "b"])) == [(0, 0, 0, 0, 0)]


def test_specs_name_existing_columns(spark):
    for dataset in DATASETS:
        empty = spark.createDataFrame([], landing_schema(dataset))
        clean = conform(empty, dataset.spec)
        assert {*dataset.spec.keys, *dataset.update} == set(clean.columns), dataset.name


def test_which_datasets_check_keys_when_relaxed():
    assert CIRCUITS.spec.checked_keys and RESULTS.spec.checked_keys
    assert not RACES.spec.checked_keys and not DRIVERS.spec.checked_keys

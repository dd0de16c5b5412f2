"""Sums that do not depend on the order of the rows."""

from __future__ import annotations

import math
import random
from fractions import Fraction
from functools import reduce
from operator import add

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.functions.sums import PARTS, exact_parts, exact_total
from stratalake.operators.standings import standings


def total(df, column="x"):
    parts = df.groupBy("g").agg(*[F.expr(p).alias(n) for n, p in exact_parts(column).items()])
    return {r["g"]: r["total"] for r in parts.select("g", F.expr(exact_total({n: n for n in PARTS})).alias("total")).collect()}


POINTS = st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.1, 0.2, 0.3, 1 / 3, -0.1, 25.0, 12.5, 1e-9]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(POINTS, min_size=1, max_size=30), seed=st.integers(0, 99))
def test_any_order_and_partitioning_gives_one_total(spark, values, seed):
    shuffled = random.Random(seed).sample(values, len(values))
    got = [
        total(spark.createDataFrame([(1, v) for v in some], "g int, x double").repartition(n))[1]
        for some, n in ((values, 1), (shuffled, 3))
    ]
    assert got[0] == got[1]
    exact = [Fraction(v) for v in values if v is not None]
    assert (got[0] is None) == (not exact)
    if exact:
        assert math.isclose(got[0], float(sum(exact)), rel_tol=1e-15, abs_tol=len(exact) * 2.0**-60)


def test_values_that_have_no_fraction_or_are_no_numbers(spark):
    rows = [(1, 1e300), (1, 2.5), (2, float("inf")), (2, 1.0), (3, float("nan")), (4, None), (5, -0.0), (6, 2.0**52), (6, 0.25)]
    got = total(spark.createDataFrame(rows, "g int, x double"))
    assert got[1] == 1e300 and got[2] == math.inf and math.isnan(got[3])
    assert got[4] is None and got[5] == 0 and got[6] == 2.0**52


@pytest.mark.parametrize("spread", [False, True])
def test_equal_totals_tie_although_doubles_would_not(spark, spread):
    """0.1 + 0.2 + 0.3 depends on the order; two drivers with the same results share a rank."""
    points = {"a": [0.1, 0.2, 0.3], "b": [0.3, 0.2, 0.1], "c": [0.2, 0.3, 0.1]}
    assert len({reduce(add, p) for p in points.values()}) > 1
    fact = [(2024, d, p, False, False) for d, all_points in points.items() for p in all_points]
    for n in (1, 4):
        df = spark.createDataFrame(fact, "season int, driver_id string, points double, is_win boolean, is_podium boolean")
        people = spark.createDataFrame([(d, d.upper()) for d in points], "driver_id string, driver_name string")
        got = standings(df.repartition(n), people, "driver_id", ["driver_name"], spread=spread).collect()
        assert {r["standing"] for r in got} == {1} and len({r["total_points"] for r in got}) == 1

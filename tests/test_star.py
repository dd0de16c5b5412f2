from __future__ import annotations

import random

import pytest

from stratalake.functions import add_result_flags
from stratalake.operators import join_sides, rank_spread, standings, union_labelled
from stratalake.plans.stages import (
    constructors_dimension,
    nationality_regions,
    races_dimension,
    session_results_fact,
)
from tests.conftest import rows


def test_join_sides_null_keys_never_match(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "A"), (None, "N")], "k int, w string")
    output = {"v": "left.v", "w": "right.w"}
    assert rows(join_sides(left, right, {"k": "k"}, output)) == [("a", "A")]
    kept = join_sides(left, right, {"k": "k"}, output, how="left")
    assert rows(kept) == [("a", "A"), ("b", None), ("c", None)]


def test_union_labelled_keeps_duplicates_and_matches_by_name(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2)], "t string, n int")
    assert rows(union_labelled({"A": a, "B": b}, "kind")) == [(1, "x", "A"), (1, "x", "A"), (2, "y", "B")]
    with pytest.raises(Exception, match="(?i)cannot resolve"):
        union_labelled({"A": a, "B": b.drop("n")}, "kind").collect()


def test_lookup_has_one_row_per_nationality(spark):
    regions = nationality_regions(spark)
    counts = {r.region: r["count"] for r in regions.groupBy("region").count().collect()}
    assert counts == {
        "Europe": 24, "North America": 3, "South America": 6, "Africa": 2, "Asia": 7, "Oceania": 3,
    }
    assert regions.select("nationality").distinct().count() == 45


def test_unknown_nationality_keeps_a_null_region(spark):
    teams = spark.createDataFrame(
        [("a", "A", "Argentine-italian"), ("b", "B", "Martian"), ("c", "C", None)],
        "constructor_id string, constructor_name string, nationality string",
    )
    regions = rows(constructors_dimension(teams, nationality_regions(spark)), "constructor_id", "nationality_region")
    assert regions == [("a", "Europe"), ("b", None), ("c", None)]


def _races(spark):
    races = spark.createDataFrame(
        [(2024, 1, "R1", None, "x", "b1"), (2024, 2, "R2", None, "y", "b2"), (2024, 3, "R3", None, "z", "b2"),
         (2024, 4, "R4", None, None, "b2"), (2024, 5, "R5", None, "x", None)],
        "season int, round int, race_name string, race_date date, circuit_id string, batch_id string",
    )
    circuits = spark.createDataFrame(
        [("x", "X", "lx", "cx", "b2"), ("y", "Y", "ly", "cy", "b1")],
        "circuit_id string, circuit_name string, locality string, country string, batch_id string",
    )
    return races, circuits


def test_races_dimension_scopes(spark):
    races, circuits = _races(spark)
    everything = races_dimension(races, circuits)
    assert rows(everything, "round", "circuit_name") == [(1, "X"), (2, "Y"), (5, "X")]
    driving = races_dimension(races, circuits, "b2")
    assert rows(driving, "round", "circuit_name") == [(1, "X"), (2, "Y"), (5, "X")]
    assert rows(races_dimension(races, circuits, "b1"), "round", "circuit_name") == [(1, "X"), (2, "Y")]
    assert rows(races_dimension(races, circuits, "b2", scope="both")) == []
    with pytest.raises(ValueError, match="scope"):
        races_dimension(races, circuits, "b2", scope="?")


def test_fact_stacks_sessions_and_flags_them(spark):
    schema = "season int, round int, constructor_id string, driver_id string, race_name string, points double, final_position int, batch_id string"
    results = spark.createDataFrame([(2024, 1, "c", "d", "r", 25.0, 1, "b")], schema)
    sprints = spark.createDataFrame([(2024, 1, "c", "d", "r", 0.0, None, "b")], schema)
    fact = session_results_fact(results, sprints)
    assert "race_name" not in fact.columns and "batch_id" not in fact.columns
    assert rows(fact, "session_type", "is_win", "is_podium", "has_points") == [
        ("RACE", True, True, True), ("SPRINT", None, None, False),
    ]


def _season(spark, entities, seed=7):
    """Random results with many ties, brute-force ranks included."""
    rng = random.Random(seed)
    fact, totals = [], {}
    for season in (2023, 2024, None):
        for entity in range(entities):
            for _ in range(rng.randint(1, 3)):
                place, points = rng.choice([1, 2, 4, None]), rng.choice([0.0, 1.0, 2.0, None])
                fact.append((season, entity, place, points))
                starts, total, wins = totals.get((season, entity), (0, None, 0))
                if points is not None:
                    total = (total or 0.0) + points
                totals[season, entity] = starts + 1, total, wins + (place == 1)
    df = spark.createDataFrame(fact, "season int, driver_id int, final_position int, points double")
    dim = spark.createDataFrame([(e, f"n{e}") for e in range(entities)], "driver_id int, driver_name string")

    def score(value):
        return (float("-inf") if value[1] is None else value[1], value[2])

    expected = [
        (season, entity, 1 + sum(1 for (s, _), other in totals.items() if s == season and score(other) > score(value)))
        for (season, entity), value in totals.items()
    ]
    return add_result_flags(df), dim, sorted(expected, key=repr)


@pytest.mark.parametrize("spread", [False, True], ids=["window", "spread"])
def test_standings_against_brute_force(spark, spread):
    fact, dim, expected = _season(spark, 60)
    ranked = standings(fact, dim, "driver_id", ["driver_name"], spread=spread)
    assert ranked.columns == [
        "season", "driver_id", "driver_name", "standing",
        "race_starts", "total_points", "number_of_wins", "number_of_podiums",
    ]
    assert dict(ranked.dtypes)["standing"] == "int"
    assert rows(ranked, "season", "driver_id", "standing") == expected


def test_repeated_dimension_rows_count_as_in_a_plain_join(spark):
    fact = add_result_flags(
        spark.createDataFrame([(2024, 1, 1, 25.0)], "season int, driver_id int, final_position int, points double")
    )
    dim = spark.createDataFrame([(1, "A"), (1, "A"), (1, "B")], "driver_id int, driver_name string")
    got = rows(standings(fact, dim, "driver_id", ["driver_name"]), "driver_name", "race_starts", "total_points")
    assert got == [("A", 2, 50.0), ("B", 1, 25.0)]


def test_rank_spread_with_one_hot_score_and_more_tasks_than_scores(spark):
    df = spark.range(3000).selectExpr("1 AS g", "id", "CASE WHEN id < 1000 THEN 5 ELSE id END AS s")
    ranked = rank_spread(df, ["g"], ["s"], "r", tasks=16)
    expected = {i: 3000 - i for i in range(1000, 3000)} | {i: 2001 for i in range(1000)}
    assert {row.id: row.r for row in ranked.collect()} == expected


def test_standings_sum_before_the_join(spark):
    fact, dim, _ = _season(spark, 5)
    plan = standings(fact, dim, "driver_id", ["driver_name"])._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert "Aggregate" in plan[:join] and "Aggregate" in plan[join:]

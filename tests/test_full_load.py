from __future__ import annotations

import json
from pathlib import Path

import pytest

from stratalake.plans.datasets import CIRCUITS, RACES, RESULTS, SPRINTS
from stratalake.plans.full_load import audit, load_bronze, load_silver, run_full_load
from stratalake.sinks import TableLayout, overwrite
from tests.conftest import rows
from tests.landing_data import RESULTS as RESULT_ROWS
from tests.landing_data import SPRINTS as SPRINT_ROWS
from tests.landing_data import write_landing


@pytest.fixture
def loaded(lake):
    write_landing(Path(lake.landing))
    run_full_load(lake)
    return lake


def test_full_load(loaded):
    lake = loaded
    bronze = lake.table("bronze", "circuits")
    assert bronze.columns == [
        "circuitId", "url", "circuitName", "lat", "long", "locality", "country",
        "ingestion_timestamp", "source_file",
    ]
    assert bronze.count() == 5
    assert lake.table("bronze", "sprints").count() == 3

    circuits = rows(lake.table("silver", "circuits"), "circuit_id", "circuit_name", "locality")
    assert circuits == [
        ("interlagos", "Autódromo José Carlos Pace", "São Paulo"),
        ("monza", "Autodromo Nazionale Di Monza", "Monza"),
        ("spa", "Circuit De Spa-francorchamps", "Spa"),
    ]
    assert rows(lake.table("silver", "drivers"), "driver_id", "driver_name", "nationality") == [
        ("empty", "", None), ("leclerc", "Charles Leclerc", "Monegasque"),
        ("mixed", "O'brien", "Argentine-italian"), ("none", "", None),
        ("norris", "Lando Norris", "British"),
    ]
    assert rows(lake.table("gold", "dim_races"), "season", "round", "race_name", "circuit_name") == [
        (2024, 1, "Italian Grand Prix", "Autodromo Nazionale Di Monza"),
        (2024, 2, "Belgian Grand Prix", "Circuit De Spa-francorchamps"),
    ]
    assert rows(lake.table("gold", "dim_constructors"), "constructor_id", "nationality_region") == [
        ("ferrari", "Europe"), ("mars", None), ("mclaren", "Europe"),
    ]
    fact = lake.table("gold", "fact_session_results")
    assert sorted(fact.columns) == sorted([
        "season", "round", "constructor_id", "driver_id", "grid_position", "completed_laps",
        "car_number", "points", "final_position", "final_position_text", "status",
        "session_type", "is_win", "is_podium", "has_points",
    ])
    assert fact.count() == 9
    assert rows(fact.where("final_position IS NULL"), "driver_id", "is_win", "is_podium", "has_points") == [
        ("mixed", None, None, False),
    ]
    assert rows(fact.where("points IS NULL"), "driver_id", "is_win", "has_points") == [("mixed", False, None)]

    view = lake.table("gold", "v_driver_standing")
    assert view.columns == [
        "season", "driver_id", "driver_name", "nationality", "standing", "race_starts",
        "total_points", "number_of_wins", "number_of_podiums",
    ]
    assert rows(view, "driver_id", "standing", "race_starts", "total_points", "number_of_wins", "number_of_podiums") == [
        ("leclerc", 2, 3, 44.5, 1, 3), ("mixed", 3, 3, 2.5, 0, 0), ("norris", 1, 3, 48.0, 2, 3),
    ]
    teams = lake.spark.sql(
        f"SELECT * FROM {lake.name('gold', 'v_constructor_standing')} WHERE season = 2024"
    )
    assert rows(teams, "constructor_id", "standing", "total_points") == [
        ("ferrari", 2, 44.5), ("mars", 3, 0.0), ("mclaren", 1, 50.5),
    ]


def test_loading_again_gives_the_same(loaded):
    tables = [("silver", "results"), ("gold", "fact_session_results"), ("gold", "dim_drivers")]

    def content():
        return [
            rows(loaded.table(*t).drop("ingestion_timestamp", "created_timestamp")) for t in tables
        ]

    before = content()
    run_full_load(loaded)
    assert content() == before


def test_views_follow_a_change_of_the_fact(loaded):
    view = loaded.name("gold", "v_driver_standing")
    before = loaded.spark.table(view).agg({"race_starts": "sum"}).first()[0]
    fact = loaded.name("gold", "fact_session_results")
    overwrite(loaded.spark.table(fact).union(loaded.spark.table(fact)), fact, TableLayout(partition_by="season"))
    assert loaded.spark.table(view).agg({"race_starts": "sum"}).first()[0] == 2 * before
    run_full_load(loaded)


def test_audit_counts_removed_rows(loaded):
    assert rows(audit(loaded, RESULTS)) == [(12, 4, 1, 5, 7)]


def test_relaxed_keys_keep_one_null_group(lake):
    write_landing(Path(lake.landing))
    load_bronze(lake, RACES)
    load_silver(lake, RACES, strict_keys=False, arbitrary=True)
    assert rows(lake.table("silver", "races"), "round") == [(1,), (2,), (3,), (4,), (None,)]


def test_points_may_stay_float(lake):
    write_landing(Path(lake.landing))
    load_bronze(lake, RESULTS, points="FLOAT")
    assert dict(lake.table("bronze", "results").dtypes)["points"] == "float"


def test_bad_cell_fails_bronze_and_leaves_no_table(lake):
    write_landing(Path(lake.landing), circuits="monza,u,M,not-a-number,9.1,monza,Italy\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        load_bronze(lake, CIRCUITS)
    assert not lake.spark.catalog.tableExists(lake.name("bronze", "circuits"))


def test_sessions_may_come_as_one_file(lake):
    folder = Path(lake.landing)
    folder.mkdir(parents=True)
    (folder / "results.json").write_text(json.dumps(RESULT_ROWS[0]) + "\n")
    (folder / "sprints.json").write_text(json.dumps(SPRINT_ROWS, indent=2))
    load_bronze(lake, RESULTS)
    load_bronze(lake, SPRINTS)
    assert lake.table("bronze", "results").count() == 1
    assert lake.table("bronze", "sprints").count() == 2
    assert dict(lake.table("bronze", "sprints").dtypes)["date"] == "date"

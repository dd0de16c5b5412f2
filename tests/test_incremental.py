from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import pytest

from stratalake.plans import control
from stratalake.plans.incremental import load_bronze_batch, load_gold_batch, run_batch, run_next
from stratalake.plans.datasets import RACES
from stratalake.plans.datasets import RESULTS as RESULTS_DATASET
from stratalake.plans.full_load import audit
from stratalake.sinks import TableLayout
from stratalake.sinks.tables import _stored_layout
from tests.conftest import rows
from tests.landing_data import DRIVERS, RESULTS, session, write_landing

STAMPS = ("created_timestamp", "updated_timestamp")


def batches(lake):
    """Three batches; the second corrects a result and a driver, the third adds a season."""
    landing = Path(lake.landing)
    write_landing(landing / "2025-01")
    renamed = [{**DRIVERS[1], "nationality": "NEW ZEALANDER"}]
    corrected = [session(2024, 1, "ferrari", "leclerc", 2, 18)]
    write_landing(
        landing / "2025-02", circuits="", races="", constructors=[], drivers=renamed,
        results=corrected, sprints=[session(2024, 1, "ferrari", "leclerc", 2, 6)],
    )
    write_landing(
        landing / "2025-03", circuits="monza,u,renamed track,45.6,9.2,monza,Italy\n",
        races="2025,1,u,new race,2025-03-01,spa\n", constructors=[], drivers=[],
        results=[session(2025, 1, "mclaren", "norris", 1, 25)],
        sprints=[session(2025, 1, "mclaren", "norris", 8, 1)],
    )


def gold(lake):
    return {
        table: rows(lake.table("gold", table).drop(*STAMPS))
        for table in ("fact_session_results", "dim_drivers", "dim_constructors", "dim_races")
    }


def control_rows(lake):
    return rows(lake.spark.table(lake.control_table), "batch_id", "status")


def test_three_batches_then_an_old_one_again(lake):
    batches(lake)
    assert run_next(lake) == "2025-01"
    first = lake.table("gold", "dim_drivers").where("driver_id = 'norris'").first()
    assert first.nationality_region == "Europe"
    assert run_next(lake) == "2025-02"
    assert run_next(lake) == "2025-03"
    assert run_next(lake) is None
    assert control_rows(lake) == [(f"2025-0{n}", "completed") for n in (1, 2, 3)]

    fact = lake.table("gold", "fact_session_results")
    leclerc = fact.where("driver_id = 'leclerc' AND season = 2024 AND round = 1")
    assert rows(leclerc, "session_type", "points", "is_win") == [("RACE", 18.0, False), ("SPRINT", 6.0, False)]
    assert fact.count() == 11
    norris = lake.table("gold", "dim_drivers").where("driver_id = 'norris'").first()
    assert norris.nationality_region == "Oceania"
    assert norris.created_timestamp == first.created_timestamp < norris.updated_timestamp
    # The circuit was renamed without its race being sent again, and the new race uses
    # a circuit of the first batch.
    assert rows(lake.table("gold", "dim_races"), "season", "round", "circuit_name") == [
        (2024, 1, "Renamed Track"), (2024, 2, "Circuit De Spa-francorchamps"),
        (2025, 1, "Circuit De Spa-francorchamps"),
    ]
    silver = lake.table("silver", "results").where("driver_id = 'leclerc' AND round = 1")
    assert rows(silver, "batch_id") == [("2025-02",)]

    before = gold(lake)
    standing = rows(lake.table("gold", "v_driver_standing"))
    run_batch(lake, "2025-01")
    assert gold(lake) == before
    assert rows(lake.table("gold", "v_driver_standing")) == standing
    run_batch(lake, "2025-03")
    assert gold(lake) == before
    for table in ("results", "drivers"):
        bad = lake.table("silver", table).where("created_timestamp > updated_timestamp")
        assert bad.count() == 0
    assert lake.table("bronze", "results").groupBy("batch_id").count().count() == 3
    assert rows(audit(lake, RESULTS_DATASET, "2025-01")) == [(12, 4, 1, 5, 7)]
    assert rows(audit(lake, RESULTS_DATASET, "2025-02")) == [(1, 0, 0, 0, 1)]


def test_both_scope_loses_a_race_at_an_unsent_circuit(lake):
    batches(lake)
    for _ in range(3):
        run_next(lake, scope="both")
    assert rows(lake.table("gold", "dim_races"), "season", "round", "circuit_name") == [
        (2024, 1, "Autodromo Nazionale Di Monza"), (2024, 2, "Circuit De Spa-francorchamps"),
    ]


def test_refresh_all_applies_a_changed_lookup(lake):
    batches(lake)
    run_next(lake)
    regions = lake.name("gold", "ref_nationality_region")
    lake.spark.sql(f"INSERT INTO {regions} VALUES ('Martian', 'Space')")
    write_landing(Path(lake.landing) / "2025-09", circuits="", races="", constructors=[], drivers=[], results=RESULTS[:2])
    load_gold_batch(lake, "2025-09")
    mars = lake.table("gold", "dim_constructors").where("constructor_id = 'mars'")
    assert mars.first().nationality_region is None
    load_gold_batch(lake, "2025-09", refresh_all=True)
    assert lake.table("gold", "dim_constructors").where("constructor_id = 'mars'").first().nationality_region == "Space"


@pytest.mark.parametrize(
    ("folders", "tracked", "expected"),
    [
        (["2025-01", "2025-02"], None, "2025-01"),
        (["2025-01", "2025-02"], [("2025-01", "completed")], "2025-02"),
        (["2025-01", "2025-02"], [("2025-01", "in_progress")], "2025-02"),
        (["2025-01", "2025-02"], [("2025-01", "failed")], "2025-01"),
        (["2025-01", "2025-02", "2025-03"], [("2025-02", "completed")], "2025-01"),
        (["2025-01"], [("2025-01", "completed"), ("2025-01", "in_progress")], None),
        ([], [], None),
        ([], None, None),
    ],
)
def test_next_batch(lake, folders, tracked, expected):
    for name in folders:
        (Path(lake.landing) / name).mkdir(parents=True)
    if tracked is not None:
        control.create_control_table(lake)
        for batch_id, status in tracked:
            lake.spark.sql(
                f"INSERT INTO {lake.control_table} VALUES ('{batch_id}', '{status}', now(), now())"
            )
    assert control.next_batch(lake) == expected


def test_start_and_complete(lake):
    control.start_batch(lake, "2025-01")
    control.start_batch(lake, "2025-01")
    control.start_batch(lake, "2025-02")
    assert control_rows(lake) == [("2025-01", "in_progress"), ("2025-02", "in_progress")]
    control.complete_batch(lake, "2025-01")
    control.complete_batch(lake, "2025-09")
    assert control_rows(lake) == [("2025-01", "completed"), ("2025-02", "in_progress")]
    control.start_batch(lake, "2025-02", keep_attempts=True)
    assert len(control_rows(lake)) == 3
    control.complete_batch(lake, "2025-02")
    assert control_rows(lake) == [("2025-01", "completed"), ("2025-02", "completed"), ("2025-02", "completed")]
    control.reset_control_table(lake)
    assert control_rows(lake) == []
    control.record_event(lake, 1)
    control.record_event(lake, 2)
    assert rows(lake.table("control", "batch_events"), "batch_id") == [(1,), (2,)]


@pytest.mark.parametrize("batch_id", ["", None])
def test_a_missing_batch_id_is_an_error_everywhere(lake, batch_id):
    for step in (
        lambda: control.start_batch(lake, batch_id),
        lambda: control.complete_batch(lake, batch_id),
        lambda: load_bronze_batch(lake, RACES, batch_id),
        lambda: load_gold_batch(lake, batch_id),
        lambda: run_batch(lake, batch_id),
    ):
        with pytest.raises(ValueError, match="batch_id is missing"):
            step()


def test_a_failed_batch_stays_in_progress_and_can_be_repeated(lake):
    batches(lake)
    bad = Path(lake.landing) / "2025-01" / "races.csv"
    good = bad.read_text()
    bad.write_text(good + "not-a-year,1,u,x,2024-01-01,spa\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        run_next(lake)
    assert control_rows(lake) == [("2025-01", "in_progress")]
    assert control.next_batch(lake) == "2025-02"
    bad.write_text(good)
    run_batch(lake, "2025-01")
    assert control_rows(lake) == [("2025-01", "completed")]
    assert lake.table("gold", "fact_session_results").count() == 9


def test_other_layouts_give_the_same_gold(lake):
    batches(lake)
    while run_next(lake):
        pass
    expected = gold(lake)
    bucketed = replace(
        lake,
        prefix=lake.prefix + "b_",
        location=lake.location + "_b",
        layouts={
            "silver.drivers": TableLayout(bucket_by=("driver_id",), buckets=3),
            "silver.results": TableLayout(),
            "gold.fact_session_results": TableLayout("season", ("driver_id", "round"), 2),
        },
    )
    while run_next(bucketed):
        pass
    layout = _stored_layout(lake.spark, bucketed.name("gold", "fact_session_results"))
    assert layout == bucketed.layouts["gold.fact_session_results"]

    def by_name(tables):
        return {name: sorted(data, key=repr) for name, data in tables.items()}

    assert by_name(gold(bucketed)) == by_name(expected)

"""Audits, claims, discovery, pruned reads, and several batches in one go."""

from __future__ import annotations

from dataclasses import replace
from pathlib import Path
from threading import Barrier, Event, Thread

import pytest
from pyspark.sql import functions as F

from stratalake.operators.quality import RowLoss, removed_rows
from stratalake.operators.conform import conform
from stratalake.plans import claims, control, incremental
from stratalake.plans.backlog import run_backlog
from stratalake.plans.claims import BatchClaimed, claimed
from stratalake.plans.datasets import CIRCUITS, DATASETS, RESULTS
from stratalake.plans.full_load import audit, run_full_load
from stratalake.plans.incremental import run_batch, run_next, sessions_written_by
from tests.conftest import rows
from tests.landing_data import session, write_landing
from tests.test_incremental import batches, control_rows, gold

SILVER = tuple(dataset.name for dataset in DATASETS)
TIMES = ("ingestion_timestamp", "source_file", "created_timestamp", "updated_timestamp")


def silver(lake):
    return {name: rows(lake.table("silver", name).drop(*TIMES)) for name in SILVER}


def audits(lake):
    return rows(lake.spark.table(lake.audit_table).drop("audited_timestamp"))


# -- audits -------------------------------------------------------------------------------


@pytest.mark.parametrize("strict", [True, False])
def test_full_load_keeps_what_cleaning_removed(lake, strict):
    write_landing(Path(lake.landing))
    run_full_load(lake, strict_keys=strict)
    counted = [
        (dataset.name, None, *audit(lake, dataset, strict_keys=strict).first()) for dataset in DATASETS
    ]
    assert audits(lake) == sorted(counted, key=repr)
    assert ("circuits", None, 5, 1, 1, 2, 3) in audits(lake)
    run_full_load(lake, strict_keys=strict)
    assert len(audits(lake)) == 6


def test_each_batch_keeps_its_own_audit(lake):
    batches(lake)
    while run_next(lake):
        pass
    run_batch(lake, "2025-01")
    counted = [
        (dataset.name, f"2025-0{n}", *audit(lake, dataset, f"2025-0{n}").first())
        for dataset in DATASETS for n in (1, 2, 3)
    ]
    assert audits(lake) == sorted(counted, key=repr) and len(counted) == 18


def test_counts_come_from_the_write_itself(spark, lake):
    """One job computes rows and counts; an empty input counts as none."""
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "circuitId string, n int")
    spec = replace(CIRCUITS.spec, columns=(), renames={"circuitId": "circuit_id"}, title=())
    for some in (df, df.limit(0), df.where("n > 99"), df.where("circuitId is null"), df.repartition(3).where("n > 2")):
        loss = RowLoss({"all": F.lit(True), "small": F.col("n") < 2})
        assert conform(some, spec, audit=loss).count() == some.where("circuitId is not null").select("circuitId").distinct().count()
        want = removed_rows(some.withColumnRenamed("circuitId", "circuit_id"), ("circuit_id",)).first().asDict()
        assert loss.counts()["all"] == want
        assert loss.counts()["small"]["rows_in"] == some.where("n < 2").count()


# -- discovery ----------------------------------------------------------------------------


def test_other_folders_neither_become_batches_nor_stop_discovery(lake):
    for name in ("archive", "old", "2025-01", "2025-02", "1999", "_tmp"):
        (Path(lake.landing) / name).mkdir(parents=True)
    control.create_control_table(lake)
    lake.spark.sql(f"INSERT INTO {lake.control_table} VALUES ('1999', 'completed', now(), now())")
    assert control.pending_batches(lake) == ["2025-01", "2025-02"]  # the id of another length is finished
    assert control.next_batch(lake) == "2025-01"
    named = replace(lake, batch_pattern="ar.*")
    assert control.next_batch(named) == "archive"
    lake.spark.sql(f"INSERT INTO {lake.control_table} VALUES ('1999', 'failed', now(), now())")
    control.reset_control_table(lake)
    with pytest.raises(ValueError, match="differ in length"):
        control.next_batch(lake)


# -- claims -------------------------------------------------------------------------------


def test_of_two_starters_one_loads_and_one_stops(lake, monkeypatch):
    batches(lake)
    loading, go_on, outcome = Event(), Event(), []
    start = control.start_batch

    def slow_start(*args, **options):
        loading.set()
        assert go_on.wait(120)
        start(*args, **options)

    monkeypatch.setattr(incremental.control, "start_batch", slow_start)

    def first():
        run_batch(lake, "2025-01")
        outcome.append("loaded")

    thread = Thread(target=first)
    thread.start()
    assert loading.wait(120)
    with pytest.raises(BatchClaimed, match="2025-01 is being loaded by local-"):
        run_batch(lake, "2025-01")
    with pytest.raises(BatchClaimed):
        run_next(lake)
    go_on.set()
    thread.join()
    assert outcome == ["loaded"] and control_rows(lake) == [("2025-01", "completed")]
    run_batch(lake, "2025-01")  # the claim went with the load


def test_only_one_of_many_gets_the_marker(lake):
    held, together, done = [], Barrier(8), Event()

    def grab():
        together.wait()
        try:
            with claimed(lake, "2025-01"):
                held.append(1)
                done.wait(20)
        except BatchClaimed:
            held.append(0)
            if held.count(0) == 7:
                done.set()

    threads = [Thread(target=grab) for _ in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(held) == [0] * 7 + [1]


@pytest.mark.parametrize("distributed", [False, True])
def test_a_claim_left_behind_is_taken_over(lake, monkeypatch, distributed):
    if distributed:  # the path that file systems other than the local one take
        monkeypatch.setattr(claims, "_local", lambda path: None)
    dead = claimed(lake, "2025-01")
    dead.__enter__()
    with pytest.raises(BatchClaimed), claimed(lake, "2025-01"):
        pass
    with claimed(lake, "2025-01", take_over=True):
        dead.__exit__(None, None, None)  # must not remove a marker that is another's now
        with pytest.raises(BatchClaimed), claimed(lake, "2025-01"):
            pass
    with claimed(lake, "2025-01"):
        pass


def test_a_failed_load_gives_the_claim_back(lake):
    batches(lake)
    (Path(lake.landing) / "2025-01" / "races.csv").write_text("broken header\n")
    for _ in range(2):
        with pytest.raises(Exception) as error:
            run_batch(lake, "2025-01")
        assert not isinstance(error.value, BatchClaimed)


# -- pruned reads -------------------------------------------------------------------------


def test_gold_reads_only_the_seasons_of_the_batch(lake):
    batches(lake)
    while run_next(lake):
        pass
    for batch_id, seasons in (("2025-03", {2025}), ("2025-02", {2024})):
        mine = sessions_written_by(lake, RESULTS, batch_id)
        assert {r.season for r in mine.collect()} == seasons
        assert rows(mine) == rows(lake.table("silver", "results").where(F.col("batch_id") == batch_id))
        plan = mine._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan" in line and ".results[" in line and "PartitionFilters" in line and "silver" in line)
        assert "PartitionFilters: [isnotnull(season" in scan and "dynamicpruning" in scan, scan


# -- several batches in one go -------------------------------------------------------------


def awkward_batches(lake):
    """What makes order matter: a race that moves to an unknown circuit, a circuit that comes late,
    rows of one key in every batch, repeated and null keys."""
    landing = Path(lake.landing)
    write_landing(landing / "2025-01")
    write_landing(
        landing / "2025-02", circuits="monza,u,renamed track,45.6,9.2,monza,Italy\n",
        races="2024,1,u,moved away,2024-09-01,nowhere\n2024,3,u,found at last,2024-10-01,late\n",
        constructors=[{"constructorId": "ferrari", "name": "Scuderia", "nationality": "ITALIAN"}, {"name": "no id"}],
        drivers=[], results=[session(2024, 1, "ferrari", "leclerc", 2, 18), session(2024, 1, "ferrari", "leclerc", 2, 18)],
        sprints=[session(2024, 1, "ferrari", "leclerc", 2, 6)],
    )
    write_landing(
        landing / "2025-03", circuits="late,u,late track,1,2,somewhere,Italy\nmonza,u,third name,45.6,9.2,monza,Italy\n",
        races="2024,2,u,second name,2024-07-28,\n2025,1,u,new race,2025-03-01,spa\n",
        constructors=[{"constructorId": "ferrari", "name": "Ferrari again", "nationality": "british"}], drivers=[],
        results=[session(2025, 1, "mclaren", "norris", 1, 25), session(2024, 1, "ferrari", "leclerc", 3, 15)],
        sprints=[session(2025, 1, "mclaren", "norris", 8, 1)],
    )


def jobs(spark):
    return spark._jsc.sc().dagScheduler().nextJobId()


@pytest.mark.parametrize(
    ("make", "loaded"), [(batches, ()), (awkward_batches, ()), (awkward_batches, ("2025-02",))]
)
def test_a_backlog_equals_its_batches_one_by_one(lake, make, loaded):
    """Also when some batches are loaded already, the last of them newer than what is pending."""
    make(lake)
    other = replace(lake, prefix=lake.prefix + "o_", location=lake.location + "_o")
    for each in (lake, other):
        each.create_schemas()
        for batch_id in loaded:
            run_batch(each, batch_id)
    pending = [b for b in ("2025-01", "2025-02", "2025-03") if b not in loaded]
    before = jobs(lake.spark)
    for batch_id in pending:
        run_batch(lake, batch_id)
    between = jobs(lake.spark)
    assert run_backlog(other) == pending
    assert jobs(lake.spark) - between < 0.75 * (between - before)
    assert gold(other) == gold(lake) and silver(other) == silver(lake)
    assert audits(other) == audits(lake) and control_rows(other) == control_rows(lake)
    assert run_backlog(other) == [] and run_next(other) is None
    again = gold(other)
    run_backlog(other, pending)  # repeating it changes nothing
    assert gold(other) == again


def test_null_keys_of_every_batch_stay_in_a_relaxed_backlog(lake):
    awkward_batches(lake)
    other = replace(lake, prefix=lake.prefix + "o_", location=lake.location + "_o")
    while run_next(lake, strict_keys=False):
        pass
    run_backlog(other, strict_keys=False)
    assert silver(other)["constructors"] == silver(lake)["constructors"]
    assert sum(r[0] is None for r in rows(other.table("silver", "constructors"), "constructor_id")) == 2
    assert gold(other) == gold(lake) and audits(other) == audits(lake)


def test_a_failed_backlog_is_repeated(lake):
    batches(lake)
    bad = Path(lake.landing) / "2025-02" / "races.csv"
    good = bad.read_text()
    bad.write_text(good + "not-a-year,1,u,x,2024-01-01,spa\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        run_backlog(lake)
    assert {status for _, status in control_rows(lake)} == {"in_progress"}
    bad.write_text(good)
    ids = [f"2025-0{n}" for n in (1, 2, 3)]
    assert run_backlog(lake, ids) == ids
    assert lake.table("gold", "fact_session_results").count() == 11

"""Batch control: which landing batch is next, started, completed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.lineage import UPDATED_AT, stamp_write_times
from stratalake.plans.lake import Lake
from stratalake.sinks.tables import append, delete_all, ensure_table, insert_values, overwrite, upsert
from stratalake.sources.landing import in_time_order, landing_batches, valid_batch_id

# The states a batch row can be in, and the control tables' columns.
IN_PROGRESS, COMPLETED = "in_progress", "completed"
CONTROL_COLUMNS = (
    "batch_id STRING, status STRING, created_timestamp TIMESTAMP, updated_timestamp TIMESTAMP"
)
EVENT_COLUMNS = "batch_id INT, event_timestamp TIMESTAMP"

# What the upsert need not find out about a source of a few literal rows.
_FEW_ROWS = {"unique_source": True, "small_source": False}


def create_control_table(lake: Lake) -> None:
    ensure_table(lake.spark, lake.control_table, CONTROL_COLUMNS)


def reset_control_table(lake: Lake) -> None:
    delete_all(lake.spark, lake.control_table)


def record_event(lake: Lake, number: int) -> None:
    """Append one row to the small event table, which is created on first use."""
    events = lake.name("control", "batch_events")
    ensure_table(lake.spark, events, EVENT_COLUMNS)
    insert_values(lake.spark, events, f"({int(number)}, current_timestamp())")


def tracked(control: DataFrame) -> DataFrame:
    """Ids discovery must skip: running (or stuck) batches and finished ones."""
    return control.where(F.col("status").isin(IN_PROGRESS, COMPLETED)).select("batch_id").distinct()


def untracked(candidates: DataFrame, control: DataFrame) -> DataFrame:
    """Candidate ids without a tracked control row."""
    return candidates.join(tracked(control), "batch_id", "left_anti")


def first_untracked(candidates: DataFrame, control: DataFrame) -> DataFrame:
    """One row holding the smallest candidate id that is not tracked, or null."""
    return untracked(candidates, control).agg(F.min("batch_id").alias("batch_id"))


def pending_batches(lake: Lake) -> list[str]:
    """Landing batches that are not tracked, oldest first.

    Tracked ids are taken away first: only what is left must have an order in time.
    """
    spark, found = lake.spark, landing_batches(lake.spark, lake.landing, lake.batch_pattern)
    if found and spark.catalog.tableExists(lake.control_table):
        candidates = spark.createDataFrame([(name,) for name in found], "batch_id string")
        found = [row[0] for row in untracked(candidates, spark.table(lake.control_table)).collect()]
    return in_time_order(found)


def next_batch(lake: Lake) -> str | None:
    """The earliest landing batch that is not tracked; ``None`` when there is none."""
    return next(iter(pending_batches(lake)), None)


def _control_rows(lake: Lake, batch_ids: Sequence[str], status: str) -> DataFrame:
    ids = F.explode(F.array(*[F.lit(valid_batch_id(batch_id)) for batch_id in batch_ids]))
    rows = lake.spark.range(1, numPartitions=1).select(ids.alias("batch_id"))
    return stamp_write_times(rows.withColumn("status", F.lit(status)))


def start_batch(lake: Lake, *batch_ids: str | None, keep_attempts: bool = False) -> None:
    """Mark batches as running.

    A second start of the same batch refreshes its row; ``keep_attempts`` appends
    another row instead.
    """
    rows = _control_rows(lake, batch_ids, IN_PROGRESS)
    create_control_table(lake)
    if keep_attempts:
        append(rows, lake.control_table)
    else:
        upsert(
            rows, lake.control_table, keys=["batch_id"], update=["status", UPDATED_AT], **_FEW_ROWS
        )


def complete_batch(lake: Lake, *batch_ids: str | None) -> None:
    """Mark running batches as finished; rows in any other state are left alone."""
    upsert(
        _control_rows(lake, batch_ids, COMPLETED),
        lake.control_table,
        keys=["batch_id"],
        match=f"t.status = '{IN_PROGRESS}'",
        update=["status", UPDATED_AT],
        insert=False,
        **_FEW_ROWS,
    )


# -- row-loss audits ----------------------------------------------------------------------

AUDIT_COLUMNS = (
    "dataset STRING, batch_id STRING, rows_in BIGINT, invalid_rows BIGINT, duplicate_rows BIGINT, "
    "removed_rows BIGINT, rows_out BIGINT"
)
_AUDIT_NUMBERS = ("rows_in", "invalid_rows", "duplicate_rows", "removed_rows", "rows_out")


def record_audits(lake: Lake, found: Mapping[str, Mapping[str | None, Mapping[str, int]]]) -> None:
    """Keep what cleaning removed: one row per dataset and batch, the last load of a batch counting.

    ``found`` has the counts by dataset and batch id; a full load has no batch id and replaces
    the whole table.
    """
    rows = [
        (dataset, batch_id, *[counts[number] for number in _AUDIT_NUMBERS])
        for dataset, batches in found.items()
        for batch_id, counts in batches.items()
    ]
    table = lake.spark.createDataFrame(rows, AUDIT_COLUMNS).withColumn("audited_timestamp", F.current_timestamp())
    if any(batch_id is None for _, batch_id, *_ in rows):
        overwrite(table.coalesce(1), lake.audit_table)
    else:
        update = [*_AUDIT_NUMBERS, "audited_timestamp"]
        upsert(table.coalesce(1), lake.audit_table, keys=["dataset", "batch_id"], update=update, **_FEW_ROWS)

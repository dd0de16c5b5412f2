"""Batch control over the days of the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.functions import stamp_write_times
from stratalake.plans.control import complete_batch as complete_batch_rows
from stratalake.plans.control import first_untracked, start_batch, tracked, untracked
from stratalake.sinks import overwrite, upsert
from workloads.registry import load, new_lake, query

# A day counts as completed, in progress or failed by its number of events.
DAYS_SQL = """
    SELECT strftime(ts, '%Y-%m-%d') AS batch_id,
           CASE count(*) % 3 WHEN 0 THEN 'completed' WHEN 1 THEN 'in_progress' ELSE 'failed' END
               AS status
    FROM events GROUP BY ALL
"""


def _days(spark, sf_dir):
    kind = F.count(F.lit(1)) % 3
    return (
        load(spark, sf_dir, "events")
        .groupBy(F.date_format("ts", "yyyy-MM-dd").alias("batch_id"))
        .agg(
            F.when(kind == 0, "completed").when(kind == 1, "in_progress").otherwise("failed").alias("status")
        )
    )


@query(f"SELECT min(batch_id) AS batch_id FROM ({DAYS_SQL}) WHERE status = 'failed'")
def next_batch(spark, sf_dir):
    days = _days(spark, sf_dir)
    return first_untracked(days.select("batch_id"), days)


@query(f"SELECT batch_id FROM ({DAYS_SQL}) WHERE status = 'failed'")
def untracked_batches(spark, sf_dir):
    """Set difference: all days minus the tracked ones."""
    days = _days(spark, sf_dir)
    return untracked(days.select("batch_id"), days)


@query(f"SELECT batch_id FROM ({DAYS_SQL}) WHERE status IN ('in_progress', 'completed')")
def tracked_batches(spark, sf_dir):
    return tracked(_days(spark, sf_dir))


@query(
    f"""
    SELECT batch_id, CASE status WHEN 'in_progress' THEN 'completed' ELSE status END AS status
    FROM ({DAYS_SQL})
    """
)
def complete_batch(spark, sf_dir):
    """Update-only merge: only running days change, and no row is added."""
    lake = new_lake(spark, "control")
    days = stamp_write_times(_days(spark, sf_dir))
    overwrite(days, lake.control_table)
    done = days.withColumn("status", F.lit("completed"))
    stranger = done.withColumn("batch_id", F.concat("batch_id", F.lit("-late")))
    upsert(
        done.unionByName(stranger),
        lake.control_table,
        keys=["batch_id"],
        match="t.status = 'in_progress'",
        update=["status", "updated_timestamp"],
        insert=False,
    )
    return spark.table(lake.control_table).select("batch_id", "status")


@query(
    f"""
    SELECT batch_id, CASE status WHEN 'failed' THEN 'in_progress' ELSE 'completed' END AS status
    FROM ({DAYS_SQL}) CROSS JOIN (VALUES (1), (2)) attempts(n)
    """
)
def batch_attempts(spark, sf_dir):
    """Every day is started twice, each attempt with a row of its own; all but the failed days end."""
    lake = new_lake(spark, "attempts")
    days = {row.batch_id: row.status for row in _days(spark, sf_dir).collect()}
    for _ in range(2):
        start_batch(lake, *days, keep_attempts=True)
    complete_batch_rows(lake, *[day for day, status in days.items() if status != "failed"])
    return spark.table(lake.control_table).select("batch_id", "status")

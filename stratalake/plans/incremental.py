"""Incremental load: one landing batch at a time, rerunnable at every step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.lineage import BATCH_ID, LINEAGE_COLUMNS, UPDATED_AT, stamp_write_times
from stratalake.operators.conform import conform
from stratalake.operators.quality import RowLoss
from stratalake.plans import control
from stratalake.plans.claims import claimed
from stratalake.plans.datasets import DATASETS, FACT_KEYS, FACT_UPDATE, RESULTS, SPRINTS, Dataset
from stratalake.plans.full_load import gold_layout, load_lookup, together
from stratalake.plans.lake import Lake
from stratalake.plans.stages import (
    constructors_dimension,
    drivers_dimension,
    of_batch,
    races_dimension,
    scan_landing,
    session_results_fact,
    written_by,
)
from stratalake.plans.views import build_views
from stratalake.sinks.tables import PLAIN, TableLayout, is_large, replace_partition, upsert
from stratalake.sources.landing import batch_path, valid_batch_id

# A batch must not overwrite a row that a later batch has written.
NOT_OLDER = f"s.{BATCH_ID} >= t.{BATCH_ID}"
# Merge keys and updated columns of the gold dimensions.
DIMENSIONS = {
    "dim_races": (
        ("season", "round"),
        ("race_name", "race_date", "circuit_name", "locality", "country"),
    ),
    "dim_constructors": (
        ("constructor_id",),
        ("constructor_name", "nationality", "nationality_region"),
    ),
    "dim_drivers": (
        ("driver_id",),
        ("driver_name", "date_of_birth", "nationality", "nationality_region"),
    ),
}


def write_silver(
    rows: DataFrame, name: str, keys: tuple[str, ...], update: tuple[str, ...],
    layout: TableLayout = PLAIN, bronze: DataFrame | None = None,
) -> None:
    """Guarded upsert: newer or equal batches update, the creation time stays.
    ``rows`` hold each key once, as :func:`conform` leaves them.  ``bronze`` are the rows they were
    cleaned from, all key columns checked: if they are many, they are cleaned in the merge."""
    upsert(
        stamp_write_times(rows),
        name,
        keys=keys,
        update=[*update, *LINEAGE_COLUMNS, UPDATED_AT],
        guard=NOT_OLDER,
        layout=layout,
        unique_source=True,
        **_in_the_merge(bronze, layout),
        keys_checked=bronze is not None,
    )


def _in_the_merge(bronze: DataFrame | None, layout: TableLayout) -> dict:
    """Options of an upsert whose source comes from ``bronze``: a large one is not written down first."""
    if bronze is None or not set(layout.partition_columns) <= set(bronze.columns) or not is_large(bronze):
        return {}
    return {"small_source": False, "reaching": bronze}


def write_gold(
    rows: DataFrame, name: str, keys: tuple[str, ...], update: tuple[str, ...],
    layout: TableLayout = PLAIN, bronze: DataFrame | None = None,
) -> None:
    """Unguarded upsert.  Safe for an old batch, because gold only receives the silver
    rows that batch wrote last.  The merge itself finds out if ``rows`` repeat a key of gold.
    ``bronze`` are the rows they go back to, as in :func:`write_silver`."""
    upsert(
        stamp_write_times(rows), name, keys=keys, update=[*update, UPDATED_AT], layout=layout,
        **_in_the_merge(bronze, layout),
    )


def bronze_sessions(lake: Lake, *batch_ids: str) -> DataFrame:
    """The batches' results and sprints as they landed."""
    results, sprints = (of_batch(lake.table("bronze", d.name), *batch_ids) for d in (RESULTS, SPRINTS))
    return results.unionByName(sprints)


def load_bronze_batch(lake: Lake, dataset: Dataset, batch_id: str, points: str = "DOUBLE") -> None:
    folder = batch_path(lake.landing, batch_id, "")
    scan = scan_landing(lake.spark, folder, dataset, points)
    replace_partition(scan, lake.name("bronze", dataset.name), BATCH_ID, batch_id)


def load_silver_batch(
    lake: Lake, dataset: Dataset, batch_id: str, *, strict_keys: bool = True,
    arbitrary: bool = False,
) -> dict[str | None, dict[str, int]]:
    """Merge one batch; returns what cleaning removed, counted while the rows were written."""
    bronze = of_batch(lake.table("bronze", dataset.name), valid_batch_id(batch_id))
    audit = RowLoss({batch_id: F.lit(True)})
    write_silver(
        conform(bronze, dataset.spec, strict_keys=strict_keys, arbitrary=arbitrary, audit=audit),
        lake.name("silver", dataset.name),
        dataset.spec.keys,
        dataset.update,
        lake.layout("silver", dataset.name, dataset.layout),
        bronze if all_keys_checked(dataset) else None,
    )
    return audit.counts()


def all_keys_checked(dataset: Dataset) -> bool:
    """Whether cleaning rejects every null key, strict or not."""
    return set(dataset.spec.keys) <= set(dataset.spec.checked_keys)


def sessions_written_by(lake: Lake, dataset: Dataset, *batch_ids: str) -> DataFrame:
    """Silver results or sprints that the batches wrote last, read from their own seasons."""
    silver = lake.table("silver", dataset.name)
    if "season" not in lake.layout("silver", dataset.name, dataset.layout).partition_columns:
        return of_batch(silver, *batch_ids)
    return written_by(silver, lake.table("bronze", dataset.name), "season", *batch_ids)


def load_gold_batch(
    lake: Lake, batch_id: str, *, scope: str = "driving", refresh_all: bool = False
) -> None:
    """Merge what the batch changed into gold.

    ``scope`` is explained at :func:`races_dimension`.  ``refresh_all`` rebuilds
    the driver and constructor rows of all batches, which is what a changed
    look-up needs.
    """
    valid_batch_id(batch_id)

    def silver(table: str) -> DataFrame:
        return lake.table("silver", table)

    def changed(table: str) -> DataFrame:
        return silver(table) if refresh_all else of_batch(silver(table), batch_id)

    regions = lake.table("gold", "ref_nationality_region")
    builds = {
        "dim_races": lambda: races_dimension(silver("races"), silver("circuits"), batch_id, scope),
        "dim_constructors": lambda: constructors_dimension(changed("constructors"), regions),
        "dim_drivers": lambda: drivers_dimension(changed("drivers"), regions),
        "fact_session_results": lambda: session_results_fact(
            sessions_written_by(lake, RESULTS, batch_id), sessions_written_by(lake, SPRINTS, batch_id)
        ),
    }
    merge_rules = DIMENSIONS | {"fact_session_results": (FACT_KEYS, FACT_UPDATE)}

    def build(table: str) -> None:
        keys, update = merge_rules[table]
        bronze = bronze_sessions(lake, batch_id) if table.startswith("fact") else None
        write_gold(builds[table](), lake.name("gold", table), keys, update, gold_layout(lake, table), bronze)

    together(build, builds)


def run_batch(
    lake: Lake, batch_id: str | None, *, strict_keys: bool = True, arbitrary: bool = False,
    scope: str = "driving", refresh_all: bool = False, points: str = "DOUBLE",
    take_over: bool = False,
) -> None:
    """Load one batch through all tiers, from marking it started to marking it completed.

    A batch that fails stays ``in_progress``; running it again repeats it safely.  While a batch is
    loaded nobody else can start it (:class:`~stratalake.plans.claims.BatchClaimed`); ``take_over``
    repeats a batch whose driver was killed.
    """
    batch_id = valid_batch_id(batch_id)
    lake.create_schemas()
    with claimed(lake, batch_id, take_over=take_over):
        _load_batch(lake, batch_id, strict_keys, arbitrary, scope, refresh_all, points)


def _load_batch(
    lake: Lake, batch_id: str, strict_keys: bool = True, arbitrary: bool = False,
    scope: str = "driving", refresh_all: bool = False, points: str = "DOUBLE",
) -> None:
    control.start_batch(lake, batch_id)
    audits = {}

    def refine(dataset: Dataset) -> None:
        load_bronze_batch(lake, dataset, batch_id, points)
        audits[dataset.name] = load_silver_batch(
            lake, dataset, batch_id, strict_keys=strict_keys, arbitrary=arbitrary
        )

    together(refine, DATASETS)
    control.record_audits(lake, audits)
    load_lookup(lake)
    load_gold_batch(lake, batch_id, scope=scope, refresh_all=refresh_all)
    build_views(lake)
    control.complete_batch(lake, batch_id)


def run_next(lake: Lake, **options) -> str | None:
    """Load the earliest batch that is not tracked yet; ``None`` when there is none.

    The batch is claimed before it is looked at again, so that of two drivers that found the same
    batch only one loads it; the other gets :class:`~stratalake.plans.claims.BatchClaimed` while
    that goes on, and the batch after it later.
    """
    lake.create_schemas()
    while (batch_id := control.next_batch(lake)) is not None:
        with claimed(lake, batch_id):
            if batch_id in control.pending_batches(lake):
                _load_batch(lake, batch_id, **options)
                return batch_id
    return None

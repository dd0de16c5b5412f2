"""Full load: every tier is rebuilt from the landing files."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from stratalake.operators.conform import conform, shape
from stratalake.operators.quality import RowLoss, removed_rows
from stratalake.plans.control import record_audits
from stratalake.plans.datasets import DATASETS, Dataset
from stratalake.plans.lake import Lake
from stratalake.plans.stages import (
    constructors_dimension,
    drivers_dimension,
    nationality_regions,
    of_batch,
    races_dimension,
    scan_landing,
    session_results_fact,
)
from stratalake.plans.views import build_views
from stratalake.sinks.tables import PLAIN, TableLayout, overwrite, reached_if_large

FACT_LAYOUT = TableLayout(partition_by="season")


def gold_layout(lake: Lake, table: str) -> TableLayout:
    return lake.layout("gold", table, FACT_LAYOUT if table.startswith("fact") else PLAIN)


def together(step: Callable, items: Iterable) -> None:
    """Run independent table builds at the same time in one Spark application."""
    with ThreadPoolExecutor() as pool:
        list(pool.map(step, items))


def load_bronze(lake: Lake, dataset: Dataset, points: str = "DOUBLE") -> None:
    scan = scan_landing(lake.spark, lake.landing, dataset, points)
    overwrite(scan, lake.name("bronze", dataset.name))


def _reached(rows: DataFrame, layout: TableLayout) -> int | None:
    """How many partitions many rows reach, as far as ``rows`` have the columns to tell."""
    columns = layout.partition_columns
    return reached_if_large(rows, *columns) if columns and set(columns) <= set(rows.columns) else None


def load_silver(
    lake: Lake, dataset: Dataset, *, strict_keys: bool = True, arbitrary: bool = False
) -> dict[str | None, dict[str, int]]:
    """Clean one dataset; returns what was removed, counted while the table was written."""
    bronze, audit = lake.table("bronze", dataset.name), RowLoss()
    clean = conform(bronze, dataset.spec, strict_keys=strict_keys, arbitrary=arbitrary, audit=audit)
    layout = lake.layout("silver", dataset.name, dataset.layout)
    overwrite(clean, lake.name("silver", dataset.name), layout, partitions=_reached(bronze, layout))
    return audit.counts()


def audit(
    lake: Lake, dataset: Dataset, batch_id: str | None = None, *, strict_keys: bool = True
) -> DataFrame:
    """How many bronze rows, of one batch or in all, cleaning removes and why, counted anew.

    The loads keep the same numbers in ``control.load_audit``.
    """
    bronze, spec = lake.table("bronze", dataset.name), dataset.spec
    if batch_id is not None:
        bronze = of_batch(bronze, batch_id)
    return removed_rows(shape(bronze, spec), spec.keys, spec.keys if strict_keys else spec.checked_keys)


def load_lookup(lake: Lake) -> None:
    overwrite(nationality_regions(lake.spark).coalesce(1), lake.name("gold", "ref_nationality_region"))


def _gold_tables(lake: Lake) -> dict[str, Callable[[], DataFrame]]:
    def silver(table: str) -> DataFrame:
        return lake.table("silver", table)

    def regions() -> DataFrame:
        return lake.table("gold", "ref_nationality_region")

    return {
        "dim_races": lambda: races_dimension(silver("races"), silver("circuits")),
        "dim_constructors": lambda: constructors_dimension(silver("constructors"), regions()),
        "dim_drivers": lambda: drivers_dimension(silver("drivers"), regions()),
        "fact_session_results": lambda: session_results_fact(silver("results"), silver("sprints")),
    }


def load_gold(lake: Lake) -> None:
    load_lookup(lake)
    tables = _gold_tables(lake)

    def build(table: str) -> None:
        rows, layout = tables[table](), gold_layout(lake, table)
        overwrite(rows, lake.name("gold", table), layout, partitions=_reached(rows, layout))

    together(build, tables)


def run_full_load(
    lake: Lake, *, strict_keys: bool = True, arbitrary: bool = False, points: str = "DOUBLE"
) -> None:
    """Landing to views.  The flags relax the stricter defaults: ``strict_keys=False``
    null-checks only the keys each dataset lists, ``arbitrary=True`` keeps any duplicate,
    ``points="FLOAT"`` keeps points in single precision.  What cleaning removed is kept in
    ``control.load_audit``."""
    lake.create_schemas()
    audits = {}

    def refine(dataset: Dataset) -> None:
        load_bronze(lake, dataset, points)
        audits[dataset.name] = load_silver(lake, dataset, strict_keys=strict_keys, arbitrary=arbitrary)

    together(refine, DATASETS)
    record_audits(lake, audits)
    load_gold(lake)
    build_views(lake)

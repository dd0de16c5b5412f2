"""A backlog in one go: several pending batches, merged once per table.

The result is the one of loading the batches one after another.  Rows of all batches are cleaned
together, each batch for itself; of the rows with one key the last writer is merged.  The race
dimension needs more: a race that a batch joined to its circuit stays in gold even if a later batch
sends it to an unknown one.  So races and circuits become histories (each row with the batch it
holds from and the batch that replaces it), and the last pair whose times overlap is merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.lineage import BATCH_ID
from stratalake.operators.conform import ConformSpec, business_order, conform, keys_present, shape
from stratalake.operators.dedupe import first_per_key
from stratalake.operators.quality import RowLoss, removed_rows
from stratalake.plans import control
from stratalake.plans.claims import all_claimed
from stratalake.plans.datasets import (
    CIRCUITS,
    DATASETS,
    FACT_KEYS,
    FACT_UPDATE,
    RACES,
    RESULTS,
    SPRINTS,
    Dataset,
)
from stratalake.plans.full_load import gold_layout, load_lookup, together
from stratalake.plans.incremental import (
    DIMENSIONS,
    all_keys_checked,
    bronze_sessions,
    load_bronze_batch,
    sessions_written_by,
    write_gold,
    write_silver,
)
from stratalake.plans.lake import Lake
from stratalake.plans.stages import (
    constructors_dimension,
    drivers_dimension,
    of_batch,
    session_results_fact,
)
from stratalake.plans.views import build_views
from stratalake.storage import staged

SINCE, UNTIL = "__since", "__until"


def cleaned_batches(
    lake: Lake, dataset: Dataset, batch_ids: Sequence[str], audit: RowLoss | None = None, **options
) -> DataFrame:
    """The bronze rows of several batches, each batch cleaned for itself."""
    bronze = of_batch(lake.table("bronze", dataset.name), *batch_ids)
    per_batch = replace(dataset.spec, keys=(*dataset.spec.keys, BATCH_ID))
    return conform(bronze, per_batch, audit=audit, **options)


def last_writers(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of the rows with one key those of the last batch; rows with a null key, which no merge would
    ever match, all stay."""
    can_match = keys_present(keys)
    last = first_per_key(rows.where(can_match), keys, [F.col(BATCH_ID).desc()])
    return last.unionByName(rows.where(~can_match))


def last_cleaned(
    bronze: DataFrame, spec: ConformSpec, *, strict_keys: bool = True, arbitrary: bool = False
) -> DataFrame:
    """What :func:`last_writers` leaves of batches cleaned one by one, with one shuffle: of the rows
    with one key the first, in cleaning's own order, of the last batch."""
    order = [] if arbitrary else business_order(shape(bronze, spec), spec.keys)
    return conform(bronze, spec, strict_keys=strict_keys, order=[F.col(BATCH_ID).desc(), *order])


def batch_losses(
    bronze: DataFrame, spec: ConformSpec, batch_ids: Sequence[str]
) -> dict[str | None, dict[str, int]]:
    """What cleaning removes from each batch, for specs that check all keys: only keys are shuffled."""
    lost = removed_rows(shape(bronze, spec), spec.keys, by=BATCH_ID)
    found = {row[BATCH_ID]: row.asDict() for row in lost.collect()}
    numbers = [name for name in lost.columns if name != BATCH_ID]
    return {b: {n: found[b][n] if b in found else 0 for n in numbers} for b in batch_ids}


def history(existing: DataFrame | None, versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every state of a row: the existing one, then the versions that a guarded merge accepts, with
    the batch each holds from (null: before the backlog) and the batch it is replaced by.  Rows with
    a null key are never replaced."""
    versions = versions.withColumn(SINCE, F.col(BATCH_ID))
    if existing is not None:
        old = existing.select(*[c for c in versions.columns if c != SINCE]).withColumn(SINCE, F.lit(None).cast("string"))
        versions = versions.unionByName(old)
    can_match, never = keys_present(keys), F.lit(None).cast("string")
    loose = versions.where(~can_match).withColumn(UNTIL, never)
    versions = versions.where(can_match)
    of_key = Window.partitionBy(*keys)
    loaded = F.max(F.when(F.col(SINCE).isNull(), F.col(BATCH_ID))).over(of_key)
    accepted = F.col(SINCE).isNull() | loaded.isNull() | (F.col(BATCH_ID) >= loaded)
    return (
        versions.withColumn("__accepted", accepted)
        .where("__accepted")
        .drop("__accepted")
        .withColumn(UNTIL, F.lead(SINCE).over(of_key.orderBy(F.col(SINCE).asc_nulls_first())))
        .unionByName(loose)
    )


def races_of_backlog(races: DataFrame, circuits: DataFrame) -> DataFrame:
    """The race dimension rows that loading the batches one by one would leave in gold.

    A race and a circuit pair up while both hold; pairs older than the backlog are in gold already.
    """
    r, c = races.alias("r"), circuits.alias("c")

    def before(a: str, b: str):
        return F.col(a).isNull() | F.col(b).isNull() | (F.col(a) < F.col(b))

    same_time = before(f"r.{SINCE}", f"c.{UNTIL}") & before(f"c.{SINCE}", f"r.{UNTIL}")
    since = F.greatest(f"r.{SINCE}", f"c.{SINCE}")  # skips nulls; null if both are
    pairs = r.join(c, (F.col("r.circuit_id") == F.col("c.circuit_id")) & same_time).where(since.isNotNull())
    columns = ["season", "round", "race_name", "race_date", "circuit_name", "locality", "country"]
    named, keys = pairs.select(since.alias(SINCE), *columns), ("season", "round")
    last = first_per_key(named.where(keys_present(keys)), keys, [F.col(SINCE).desc()])
    return last.unionByName(named.where(~keys_present(keys))).drop(SINCE)


def _silver_or_none(lake: Lake, dataset: Dataset) -> DataFrame | None:
    name = lake.name("silver", dataset.name)
    return lake.spark.table(name) if lake.spark.catalog.tableExists(name) else None


def _merge_races(lake: Lake, batch_ids: Sequence[str], **options) -> None:
    """Gold races first: silver still holds the state before the backlog, so a run that fails after
    this step repeats it with the same result."""
    sides = []
    for dataset in (RACES, CIRCUITS):
        versions = cleaned_batches(lake, dataset, batch_ids, **options)
        sides.append(history(_silver_or_none(lake, dataset), versions, dataset.spec.keys))
    keys, update = DIMENSIONS["dim_races"]
    write_gold(races_of_backlog(*sides), lake.name("gold", "dim_races"), keys, update, gold_layout(lake, "dim_races"))


def load_silver_backlog(
    lake: Lake, dataset: Dataset, batch_ids: Sequence[str], **options
) -> dict[str | None, dict[str, int]]:
    """Merge the last writer of every key; returns what cleaning removed from each batch."""
    keys, name = dataset.spec.keys, lake.name("silver", dataset.name)
    rest = (keys, dataset.update, lake.layout("silver", dataset.name, dataset.layout))
    if all_keys_checked(dataset):  # no null keys, so one pass finds the row of the last batch
        bronze = of_batch(lake.table("bronze", dataset.name), *batch_ids)
        write_silver(last_cleaned(bronze, dataset.spec, **options), name, *rest, bronze)
        return batch_losses(bronze, dataset.spec, batch_ids)
    audit = RowLoss({batch_id: F.col(BATCH_ID) == batch_id for batch_id in batch_ids})
    with staged(cleaned_batches(lake, dataset, batch_ids, audit, **options), "backlog") as rows:
        write_silver(last_writers(rows, keys), name, *rest)
    return audit.counts()


def run_backlog(
    lake: Lake, batch_ids: Sequence[str] | None = None, *, strict_keys: bool = True,
    arbitrary: bool = False, points: str = "DOUBLE", refresh_all: bool = False, take_over: bool = False,
) -> list[str]:
    """Load all pending batches (or the given ones, oldest first) together; returns their ids.

    Gold rows of drivers and constructors take the look-up as it is at the end, as they would with
    ``refresh_all`` for the rows of the backlog.  A backlog that fails leaves its batches
    ``in_progress``; give them as ``batch_ids`` to repeat it.
    """
    lake.create_schemas()
    ids = list(batch_ids) if batch_ids is not None else control.pending_batches(lake)
    if not ids:
        return []
    options = {"strict_keys": strict_keys, "arbitrary": arbitrary}
    with all_claimed(lake, ids, take_over=take_over):
        control.start_batch(lake, *ids)
        together(
            lambda dataset: [load_bronze_batch(lake, dataset, batch_id, points) for batch_id in ids], DATASETS
        )
        _merge_races(lake, ids, **options)
        audits = {}

        def refine(dataset: Dataset) -> None:
            audits[dataset.name] = load_silver_backlog(lake, dataset, ids, **options)

        together(refine, DATASETS)
        control.record_audits(lake, audits)
        load_lookup(lake)
        _merge_gold(lake, ids, refresh_all)
        build_views(lake)
        control.complete_batch(lake, *ids)
    return ids


def _merge_gold(lake: Lake, batch_ids: Sequence[str], refresh_all: bool) -> None:
    regions = lake.table("gold", "ref_nationality_region")

    def changed(table: str) -> DataFrame:
        silver = lake.table("silver", table)
        return silver if refresh_all else of_batch(silver, *batch_ids)

    builds = {
        "dim_constructors": lambda: constructors_dimension(changed("constructors"), regions),
        "dim_drivers": lambda: drivers_dimension(changed("drivers"), regions),
        "fact_session_results": lambda: session_results_fact(
            sessions_written_by(lake, RESULTS, *batch_ids), sessions_written_by(lake, SPRINTS, *batch_ids)
        ),
    }
    merge_rules = DIMENSIONS | {"fact_session_results": (FACT_KEYS, FACT_UPDATE)}

    def build(table: str) -> None:
        keys, update = merge_rules[table]
        bronze = bronze_sessions(lake, *batch_ids) if table.startswith("fact") else None
        write_gold(builds[table](), lake.name("gold", table), keys, update, gold_layout(lake, table), bronze)

    together(build, builds)

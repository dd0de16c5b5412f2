"""The DataFrame of each stage, without any writing: scan, conform, dimensions, fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.flags import add_result_flags
from stratalake.functions.lineage import (
    BATCH_ID,
    LINEAGE_COLUMNS,
    WRITE_TIME_COLUMNS,
    add_ingestion_metadata,
)
from stratalake.operators.star import join_sides, union_labelled
from stratalake.plans.datasets import (
    NATIONALITIES_BY_REGION,
    RACE_SESSION,
    SPRINT_SESSION,
    Dataset,
    landing_schema,
)
from stratalake.sources.files import read_csv, read_json


def scan_landing(
    spark: SparkSession, folder: str, dataset: Dataset, points: str = "DOUBLE"
) -> DataFrame:
    """The dataset's landing files with lineage columns."""
    path, schema = f"{folder.rstrip('/')}/{dataset.landing}", landing_schema(dataset, points)
    if dataset.format == "csv":
        rows = read_csv(spark, path, schema)
    else:
        rows = read_json(spark, path, schema, multi_line=dataset.format == "json-document")
    return add_ingestion_metadata(rows)


def of_batch(rows: DataFrame, *batch_ids: str) -> DataFrame:
    """The rows of one batch, or of several."""
    if len(batch_ids) == 1:
        return rows.where(F.col(BATCH_ID) == F.lit(batch_ids[0]))
    return rows.where(F.col(BATCH_ID).isin(*batch_ids))


def written_by(silver: DataFrame, bronze: DataFrame, column: str, *batch_ids: str) -> DataFrame:
    """The rows of a silver table partitioned by ``column`` that the batches wrote last.

    Only the partitions that the batches' own bronze rows reach are read: their values, one row per
    partition at most, are broadcast and prune the scan when it starts.
    """
    reached = of_batch(bronze, *batch_ids).select(column).distinct()
    return (
        of_batch(silver, *batch_ids)
        .join(F.broadcast(reached), column, "left_semi")
        .select(silver.columns)
    )


def nationality_regions(spark: SparkSession) -> DataFrame:
    """The nationality look-up as a literal relation."""
    rows = [(n, region) for region, names in NATIONALITIES_BY_REGION.items() for n in names]
    return spark.createDataFrame(rows, "nationality string, region string")


def _sides(left: tuple[str, ...], right: tuple[str, ...]) -> dict[str, str]:
    return {c: f"left.{c}" for c in left} | {c: f"right.{c}" for c in right}


def races_dimension(
    races: DataFrame, circuits: DataFrame, batch_id: str | None = None, scope: str = "driving"
) -> DataFrame:
    """Races with their circuit; races without a known circuit are left out.

    For one batch, ``scope="driving"`` gives every race whose race row or circuit
    row changed in the batch, each joined to the whole other table;
    ``scope="both"`` only pairs rows that both changed in it.
    """
    if scope not in ("driving", "both"):
        raise ValueError(f"unknown scope {scope!r}")

    def joined(some_races: DataFrame, some_circuits: DataFrame) -> DataFrame:
        return join_sides(
            some_races,
            some_circuits,
            {"circuit_id": "circuit_id"},
            _sides(
                ("season", "round", "race_name", "race_date"),
                ("circuit_name", "locality", "country"),
            ),
        )

    if batch_id is None:
        return joined(races, circuits)
    in_batch = F.col(BATCH_ID) == F.lit(batch_id)
    if scope == "both":
        return joined(races.where(in_batch), circuits.where(in_batch))
    # Two joins with one small side each, instead of one join of both whole tables.
    other = ~F.coalesce(in_batch, F.lit(False))
    return joined(races.where(in_batch), circuits).unionByName(
        joined(races.where(other), circuits.where(in_batch))
    )


def _with_region(rows: DataFrame, regions: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    output = _sides(columns, ()) | {"nationality_region": "right.region"}
    return join_sides(rows, regions, {"nationality": "nationality"}, output, how="left")


def constructors_dimension(constructors: DataFrame, regions: DataFrame) -> DataFrame:
    return _with_region(
        constructors, regions, ("constructor_id", "constructor_name", "nationality")
    )


def drivers_dimension(drivers: DataFrame, regions: DataFrame) -> DataFrame:
    return _with_region(
        drivers, regions, ("driver_id", "driver_name", "date_of_birth", "nationality")
    )


def session_results_fact(results: DataFrame, sprints: DataFrame) -> DataFrame:
    """Race and sprint results as one fact with a session type and result flags."""
    unused = ("race_name", "race_date", *LINEAGE_COLUMNS, *WRITE_TIME_COLUMNS)
    sessions = {RACE_SESSION: results, SPRINT_SESSION: sprints}
    return add_result_flags(union_labelled(sessions, "session_type", drop=unused))

"""The racing datasets, as data: landing schemas, cleaning rules, merge rules, look-up."""

from __future__ import annotations

from dataclasses import dataclass

from stratalake.operators.conform import ConformSpec
from stratalake.sinks.tables import PLAIN, TableLayout


@dataclass(frozen=True)
class Dataset:
    """One landing dataset and its silver table.

    ``landing`` is the file or folder name, or a glob for either; ``update`` lists the
    silver columns an upsert refreshes besides the lineage columns.
    """

    name: str
    landing: str
    format: str  # "csv", "json" (lines) or "json-document" (one document per file)
    schema: str
    spec: ConformSpec
    update: tuple[str, ...]
    layout: TableLayout = PLAIN


# ---- Fixed values: names, types and orders that users of these tables rely on ------------

_SESSION_SCHEMA = """
    date DATE, raceName STRING, round INT, season INT, url STRING, constructorId STRING,
    driverId STRING, grid INT, laps INT, number INT, points {points}, position INT,
    positionText STRING, status STRING
"""

_SESSION_KEYS = ("season", "round", "constructor_id", "driver_id")

_SESSION_SPEC = ConformSpec(
    keys=_SESSION_KEYS,
    checked_keys=_SESSION_KEYS,
    columns=(
        "season", "round", "constructorId", "driverId", "date", "raceName", "grid", "laps",
        "number", "points", "position", "positionText", "status",
    ),
    renames={
        "constructorId": "constructor_id",
        "driverId": "driver_id",
        "date": "race_date",
        "raceName": "race_name",
        "grid": "grid_position",
        "laps": "completed_laps",
        "number": "car_number",
        "position": "final_position",
        "positionText": "final_position_text",
    },
    title=("race_name",),
)

_SESSION_UPDATE = (
    "race_name", "race_date", "grid_position", "completed_laps", "car_number", "points",
    "final_position", "final_position_text", "status",
)

CIRCUITS = Dataset(
    name="circuits",
    landing="circuits.csv",
    format="csv",
    schema="""
        circuitId STRING, url STRING, circuitName STRING, lat DOUBLE, long DOUBLE,
        locality STRING, country STRING
    """,
    spec=ConformSpec(
        keys=("circuit_id",),
        checked_keys=("circuit_id",),
        columns=("circuitId", "circuitName", "lat", "long", "locality", "country"),
        renames={
            "circuitId": "circuit_id",
            "circuitName": "circuit_name",
            "lat": "latitude",
            "long": "longitude",
        },
        title=("circuit_name", "locality"),
    ),
    update=("circuit_name", "latitude", "longitude", "locality", "country"),
)

RACES = Dataset(
    name="races",
    landing="races.csv",
    format="csv",
    schema="season INT, round INT, url STRING, raceName STRING, date DATE, circuitId STRING",
    spec=ConformSpec(
        keys=("season", "round"),
        columns=("season", "round", "raceName", "date", "circuitId"),
        renames={"raceName": "race_name", "date": "race_date", "circuitId": "circuit_id"},
        title=("race_name",),
    ),
    update=("race_name", "race_date", "circuit_id"),
)

CONSTRUCTORS = Dataset(
    name="constructors",
    landing="constructors.json",
    format="json",
    schema="constructorId STRING, name STRING, nationality STRING, url STRING",
    spec=ConformSpec(
        keys=("constructor_id",),
        drop=("url",),
        renames={"constructorId": "constructor_id", "name": "constructor_name"},
        title=("nationality",),
    ),
    update=("constructor_name", "nationality"),
)

DRIVERS = Dataset(
    name="drivers",
    landing="drivers.json",
    format="json",
    schema="""
        driverId STRING, name STRUCT<givenName: STRING, familyName: STRING>,
        dateOfBirth DATE, nationality STRING, url STRING
    """,
    spec=ConformSpec(
        keys=("driver_id",),
        drop=("url",),
        renames={"driverId": "driver_id", "dateOfBirth": "date_of_birth"},
        names={"driver_name": ("name.givenName", "name.familyName")},
        title=("nationality",),
    ),
    update=("driver_name", "date_of_birth", "nationality"),
)

RESULTS = Dataset(
    name="results",
    landing="{results,results.json}",
    format="json",
    schema=_SESSION_SCHEMA,
    spec=_SESSION_SPEC,
    update=_SESSION_UPDATE,
    layout=TableLayout(partition_by="season"),
)

SPRINTS = Dataset(
    name="sprints",
    landing="{sprints,sprints.json}",
    format="json-document",
    schema=_SESSION_SCHEMA,
    spec=_SESSION_SPEC,
    update=_SESSION_UPDATE,
    layout=TableLayout(partition_by="season"),
)

DATASETS = (CIRCUITS, RACES, CONSTRUCTORS, DRIVERS, RESULTS, SPRINTS)

FACT_KEYS = (*_SESSION_KEYS, "session_type")
FACT_UPDATE = (
    "grid_position", "completed_laps", "car_number", "points", "final_position",
    "final_position_text", "status", "is_win", "is_podium", "has_points",
)
RACE_SESSION, SPRINT_SESSION = "RACE", "SPRINT"

NATIONALITIES_BY_REGION = {
    "Europe": (
        "British", "Italian", "French", "German", "Swiss", "Dutch", "Belgium", "Belgian",
        "Irish", "Spanish", "Austrian", "East German", "Russian", "Finnish", "Polish",
        "Portuguese", "Hungarian", "Danish", "Czech", "Liechtensteiner", "Monegasque",
        "Swedish", "Argentine-italian", "American-italian",
    ),
    "North America": ("American", "Canadian", "Mexican"),
    "South America": (
        "Brazilian", "Chilean", "Argentine", "Uruguayan", "Venezuelan", "Colombian",
    ),
    "Africa": ("South African", "Rhodesian"),
    "Asia": (
        "Indian", "Chinese", "Japanese", "Malaysian", "Hong Kong", "Indonesian", "Thai",
    ),
    "Oceania": ("Australian", "New Zealand", "New Zealander"),
}

# ---- End of fixed values ------------------------------------------------------------------


def landing_schema(dataset: Dataset, points: str = "DOUBLE") -> str:
    """Schema to read the dataset with; points may be kept as ``FLOAT``."""
    return dataset.schema.format(points=points)

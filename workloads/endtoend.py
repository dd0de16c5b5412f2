"""Whole loads: landing files made from the test tables, through all tiers, to gold.

A supplier is a circuit and a constructor, a customer a driver, a line item a race
result (``l_linestatus`` F) or a sprint result (O).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.plans.backlog import load_silver_backlog, run_backlog
from stratalake.plans.control import record_audits
from stratalake.plans.datasets import RESULTS, SPRINTS
from stratalake.plans.full_load import run_full_load
from stratalake.plans.incremental import run_next
from stratalake.plans.lake import Lake
from stratalake.plans.stages import races_dimension
from stratalake.sinks import TableLayout, overwrite
from stratalake.sinks.tables import reached_if_large
from stratalake.storage import written_copy
from workloads.files import write_json_documents
from workloads.registry import load, new_lake, query

NATIONALITIES = ("BRITISH", "ITALIAN", "argentine-italian", "NEW ZEALAND", "thai", "MARTIAN")

# Batch id, its number, first and last year of the orders in it: every order is in some batch.  The
# windows overlap, and each batch adds its number to all points, so later batches correct earlier ones.
BATCHES = (
    ("2025-01", 1, 0, 1997),
    ("2025-02", 2, 1997, 1999),
    ("2025-03", 3, 1999, 9999),
)
FULL = ("all", 0, 0, 9999)


def _nationality(nation_key: Column, number: int) -> Column:
    names = F.array(*[F.lit(name) for name in NATIONALITIES])
    return F.element_at(names, ((nation_key + number) % len(NATIONALITIES) + 1).cast("int"))


# Rows in a compressed file, which one task must read as a whole.
RECORDS_PER_FILE = 500_000


def _sessions(spark, sf_dir) -> DataFrame:
    """All sessions, joined and written once: every batch and dataset is read from this copy."""
    lines, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    orders = orders.where(F.year("o_orderdate").between(*FULL[2:]))
    season, month = F.year("l_shipdate"), F.month("l_shipdate")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.concat_ws(" ", F.lit("GRAND PRIX"), season, month).alias("raceName"),
        month.alias("round"),
        season.alias("season"),
        F.lit("none").alias("url"),
        F.concat(F.lit("s"), "l_suppkey").alias("constructorId"),
        F.when(F.col("l_tax") > 0, F.concat(F.lit("c"), "o_custkey")).alias("driverId"),
        (F.col("l_linenumber") + 1).alias("grid"),
        F.col("l_quantity").cast("int").alias("laps"),
        F.col("l_partkey").cast("int").alias("number"),
        F.col("l_quantity").alias("points"),
        F.nullif("l_linenumber", F.lit(7)).alias("position"),
        F.col("l_linenumber").cast("string").alias("positionText"),
        F.col("l_returnflag").alias("status"),
        "l_linestatus",
        "o_custkey",
        "o_orderdate",
    )
    return written_copy(rows, "sessions")


def write_landing(spark, sf_dir: str, folder: str, batch, sessions: DataFrame) -> None:
    """The six landing datasets of one batch; JSON, which repeats every name in every row, is compressed."""
    _, number, first, last = batch
    sessions = sessions.where(F.year("o_orderdate").between(first, last))
    sessions = sessions.withColumn("points", F.col("points") + number)
    suppliers, customers = load(spark, sf_dir, "supplier"), load(spark, sf_dir, "customer")

    suppliers.select(
        F.concat(F.lit("k"), "s_suppkey").alias("circuitId"),
        F.lit("none").alias("url"),
        F.upper("s_name").alias("circuitName"),
        F.col("s_acctbal").alias("lat"),
        F.lit(None).cast("double").alias("long"),
        F.lower("s_name").alias("locality"),
        F.lit("Country").alias("country"),
    ).write.csv(f"{folder}/circuits.csv", header=True)

    round_number = F.col("season") * 12 + F.col("round")
    sessions.select("season", "round", "raceName").distinct().select(
        "season",
        "round",
        F.lit("none").alias("url"),
        "raceName",
        F.make_date("season", "round", F.lit(1)).alias("date"),
        F.concat(F.lit("k"), round_number % 120).alias("circuitId"),
    ).write.csv(f"{folder}/races.csv", header=True)

    suppliers.select(
        F.concat(F.lit("s"), "s_suppkey").alias("constructorId"),
        F.col("s_name").alias("name"),
        _nationality(F.col("s_nationkey"), number).alias("nationality"),
        F.lit("none").alias("url"),
    ).write.json(f"{folder}/constructors.json")

    active = sessions.select(F.col("o_custkey").alias("c_custkey")).distinct()
    customers.join(active, "c_custkey", "left_semi").select(
        F.concat(F.lit("c"), "c_custkey").alias("driverId"),
        F.struct(
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("givenName"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("familyName"),
        ).alias("name"),
        F.date_add(F.lit("1970-01-01").cast("date"), (F.col("c_custkey") % 9999).cast("int")).alias(
            "dateOfBirth"
        ),
        _nationality(F.col("c_nationkey"), number).alias("nationality"),
        F.lit("none").alias("url"),
    ).write.json(f"{folder}/drivers.json", compression="gzip")

    races = sessions.where("l_linestatus = 'F'").drop("l_linestatus", "o_custkey", "o_orderdate")
    races.write.option("maxRecordsPerFile", RECORDS_PER_FILE).json(f"{folder}/results", compression="gzip")
    sprints = sessions.where("l_linestatus = 'O'").drop("l_linestatus", "o_custkey", "o_orderdate")
    write_json_documents(sprints, f"{folder}/sprints", compression="gzip")


# -- the same in SQL ----------------------------------------------------------------------

_NATIONALITY_SQL = "[" + ", ".join(
    f"'{name[0].upper()}{name[1:].lower()}'" if name != "NEW ZEALAND" else "'New Zealand'"
    for name in NATIONALITIES
) + "][({key} + {number}) % " + str(len(NATIONALITIES)) + " + 1]"
_REGION_SQL = """CASE {0} WHEN 'British' THEN 'Europe' WHEN 'Italian' THEN 'Europe'
    WHEN 'Argentine-italian' THEN 'Europe' WHEN 'New Zealand' THEN 'Oceania'
    WHEN 'Thai' THEN 'Asia' END"""


def gold_sql(batches) -> str:
    """CTEs ``fact``, ``dim_drivers``, ``dim_constructors`` and ``dim_races``."""
    windows = ", ".join(str(batch) for batch in batches)
    return f"""
        WITH batches(batch_id, number, first_year, last_year) AS (VALUES {windows}),
        raw AS (
            SELECT number, year(l_shipdate)::INTEGER AS season, month(l_shipdate)::INTEGER AS round,
                   's' || l_suppkey AS constructor_id,
                   CASE WHEN l_tax > 0 THEN 'c' || o_custkey END AS driver_id, o_custkey,
                   l_shipdate::DATE AS race_date, (l_linenumber + 1)::INTEGER AS grid_position,
                   l_quantity::INTEGER AS completed_laps, l_partkey::INTEGER AS car_number,
                   l_quantity + number AS points, nullif(l_linenumber, 7) AS final_position,
                   l_linenumber::VARCHAR AS final_position_text, l_returnflag AS status,
                   CASE l_linestatus WHEN 'F' THEN 'RACE' ELSE 'SPRINT' END AS session_type
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN batches ON year(o_orderdate) BETWEEN first_year AND last_year
        ),
        fact AS (
            SELECT * EXCLUDE (number, o_custkey, race_date), final_position = 1 AS is_win,
                   final_position BETWEEN 1 AND 3 AS is_podium, points > 0 AS has_points
            FROM raw WHERE driver_id IS NOT NULL
            QUALIFY row_number() OVER (
                PARTITION BY season, round, constructor_id, driver_id, session_type
                ORDER BY number DESC, race_date, grid_position, completed_laps, car_number, points,
                         final_position NULLS FIRST, final_position_text, status) = 1
        ),
        last_seen AS (SELECT o_custkey, max(number) AS number FROM raw GROUP BY ALL),
        dim_drivers AS (
            SELECT 'c' || c_custkey AS driver_id, 'Customer ' || c_name[10:] AS driver_name,
                   {_NATIONALITY_SQL.format(key="c_nationkey", number="number")} AS nationality
            FROM customer JOIN last_seen ON c_custkey = o_custkey
        ),
        dim_constructors AS (
            SELECT 's' || s_suppkey AS constructor_id, s_name AS constructor_name,
                   {_NATIONALITY_SQL.format(key="s_nationkey", number=batches[-1][1])} AS nationality
            FROM supplier
        ),
        dim_races AS (
            SELECT season, round, 'Grand Prix ' || season || ' ' || round AS race_name,
                   make_date(season, round, 1) AS race_date,
                   'Supplier#' || s_name[10:] AS circuit_name
            FROM (SELECT DISTINCT season, round FROM raw)
            JOIN supplier ON s_suppkey = (season * 12 + round) % 120
        )
    """


GOLD_SQL = (
    gold_sql(BATCHES)
    + f"""
    SELECT fact.*, race_name, race_date::VARCHAR AS race_date, circuit_name, driver_name,
           {_REGION_SQL.format("dim_drivers.nationality")} AS driver_region, constructor_name,
           {_REGION_SQL.format("dim_constructors.nationality")} AS constructor_region
    FROM fact LEFT JOIN dim_races USING (season, round)
    LEFT JOIN dim_drivers USING (driver_id) LEFT JOIN dim_constructors USING (constructor_id)
    """
)


def _lake_with_batches(spark, sf_dir: str, label: str) -> Lake:
    lake, sessions = new_lake(spark, label), _sessions(spark, sf_dir)
    for batch in BATCHES:
        write_landing(spark, sf_dir, f"{lake.landing}/{batch[0]}", batch, sessions)
    return lake


def _gold(lake: Lake) -> DataFrame:
    """The fact with the labels of its dimensions."""
    stamps = ("created_timestamp", "updated_timestamp")
    gold = {name: lake.table("gold", name).drop(*stamps) for name in (
        "fact_session_results", "dim_races", "dim_drivers", "dim_constructors"
    )}
    races = gold["dim_races"].select(
        "season", "round", "race_name", F.col("race_date").cast("string"), "circuit_name"
    )
    drivers = gold["dim_drivers"].select(
        "driver_id", "driver_name", F.col("nationality_region").alias("driver_region")
    )
    constructors = gold["dim_constructors"].select(
        "constructor_id", "constructor_name", F.col("nationality_region").alias("constructor_region")
    )
    return (
        gold["fact_session_results"]
        .join(races, ["season", "round"], "left")
        .join(drivers, ["driver_id"], "left")
        .join(constructors, ["constructor_id"], "left")
    )


@query(GOLD_SQL)
def incremental_star_end_to_end(spark, sf_dir):
    """Three batches, each picked from the landing folder and loaded through all tiers."""
    lake = _lake_with_batches(spark, sf_dir, "incremental")
    while run_next(lake) is not None:
        pass
    return _gold(lake)


@query(GOLD_SQL)
def backlog_load(spark, sf_dir):
    """The same three batches in one go: one merge per table instead of three."""
    lake = _lake_with_batches(spark, sf_dir, "backlog")
    run_backlog(lake)
    return _gold(lake)


_SESSIONS_SQL = """
    SELECT year(l_shipdate) AS season, month(l_shipdate) AS round, l_suppkey AS constructor_id,
           CASE WHEN l_tax > 0 THEN o_custkey END AS driver_id, l_linestatus,
           strftime(o_orderdate, '%Y') AS batch_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
_BY_DATASET = "CASE l_linestatus WHEN 'F' THEN 'results' ELSE 'sprints' END"


@query(
    f"""
    SELECT dataset, batch_id, rows_in, rows_in - valid_rows AS invalid_rows, valid_rows - rows_out AS duplicate_rows,
           rows_in - rows_out AS removed_rows, rows_out
    FROM (
        SELECT {_BY_DATASET} AS dataset, batch_id, count(*) AS rows_in, count(driver_id) AS valid_rows,
               count(DISTINCT CASE WHEN driver_id IS NOT NULL THEN (season, round, constructor_id, driver_id) END)
                   AS rows_out
        FROM ({_SESSIONS_SQL}) GROUP BY ALL)
    """
)
def load_audit(spark, sf_dir):
    """What loading every year's results and sprints as a batch removes, counted while silver is written."""
    lake = new_lake(spark, "audit")
    rows = _sessions(spark, sf_dir).withColumn("batch_id", F.date_format("o_orderdate", "yyyy"))
    years = [row[0] for row in rows.select("batch_id").distinct().orderBy("batch_id").collect()]
    stamped = rows.withColumns({"ingestion_timestamp": F.current_timestamp(), "source_file": F.lit("sessions")})
    for dataset, status in ((RESULTS, "F"), (SPRINTS, "O")):
        bronze = stamped.where(F.col("l_linestatus") == status).drop("l_linestatus", "o_custkey", "o_orderdate")
        layout, partitions = TableLayout(partition_by="batch_id"), reached_if_large(rows, "batch_id")
        overwrite(bronze, lake.name("bronze", dataset.name), layout, partitions=partitions)
    record_audits(lake, {d.name: load_silver_backlog(lake, d, years) for d in (RESULTS, SPRINTS)})
    # A batch without rows of a dataset has an audit row of zeros, which no group of rows has.
    return spark.table(lake.audit_table).where("rows_in > 0").drop("audited_timestamp")


_RACES_SQL = """
    SELECT DISTINCT year(l_shipdate)::INTEGER AS season, month(l_shipdate)::INTEGER AS round,
           (year(l_shipdate) * 12 + month(l_shipdate)) % 120 AS circuit, 'b' || month(l_shipdate) % 3 AS batch
    FROM lineitem
"""


@query(
    f"""
    SELECT scope, season, round, 'Race ' || season || ' ' || round AS race_name, s_name AS circuit_name
    FROM ({_RACES_SQL}) JOIN supplier ON s_suppkey = circuit, (VALUES ('driving'), ('both')) scopes(scope)
    WHERE CASE scope WHEN 'both' THEN batch = 'b1' AND s_suppkey % 3 = 1
                     ELSE batch = 'b1' OR s_suppkey % 3 = 1 END
    """
)
def races_of_one_batch(spark, sf_dir):
    """The race dimension rows that one batch changes, under both meanings of what it must bring."""
    lines, suppliers = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "supplier")
    season, month = F.year("l_shipdate"), F.month("l_shipdate")
    races = lines.select(season.alias("season"), month.alias("round")).distinct().select(
        "season",
        "round",
        F.concat_ws(" ", F.lit("Race"), "season", "round").alias("race_name"),
        F.make_date("season", "round", F.lit(1)).alias("race_date"),
        ((F.col("season") * 12 + F.col("round")) % 120).cast("long").alias("circuit_id"),
        F.concat(F.lit("b"), F.col("round") % 3).alias("batch_id"),
    )
    circuits = suppliers.select(
        F.col("s_suppkey").cast("long").alias("circuit_id"),
        F.col("s_name").alias("circuit_name"),
        F.lit("town").alias("locality"),
        F.lit("land").alias("country"),
        F.concat(F.lit("b"), F.col("s_suppkey") % 3).alias("batch_id"),
    )
    scopes = [
        races_dimension(races, circuits, "b1", scope).select(
            F.lit(scope).alias("scope"), "season", "round", "race_name", "circuit_name"
        )
        for scope in ("driving", "both")
    ]
    return scopes[0].unionByName(scopes[1])


def _standing_sql(entity: str) -> str:
    return f"""
        SELECT '{entity}' AS entity, season, {entity}_id AS id, {entity}_name AS name, nationality,
               (rank() OVER (PARTITION BY season ORDER BY total_points DESC,
                             number_of_wins DESC))::INTEGER AS standing,
               race_starts, total_points, number_of_wins, number_of_podiums
        FROM (SELECT season, {entity}_id, {entity}_name, nationality, count(*) AS race_starts,
                     sum(points) AS total_points,
                     count(*) FILTER (WHERE is_win) AS number_of_wins,
                     count(*) FILTER (WHERE is_podium) AS number_of_podiums
              FROM fact JOIN dim_{entity}s USING ({entity}_id) GROUP BY ALL)
    """


@query(gold_sql((FULL,)) + _standing_sql("driver") + " UNION ALL " + _standing_sql("constructor"))
def full_load_star_end_to_end(spark, sf_dir):
    """Everything at once, read through the two standings views."""
    lake = new_lake(spark, "full_load")
    write_landing(spark, sf_dir, lake.landing, FULL, _sessions(spark, sf_dir))
    run_full_load(lake)
    views = [
        lake.table("gold", f"v_{entity}_standing")
        .withColumnsRenamed({f"{entity}_id": "id", f"{entity}_name": "name"})
        .withColumn("entity", F.lit(entity))
        for entity in ("driver", "constructor")
    ]
    return views[0].unionByName(views[1])

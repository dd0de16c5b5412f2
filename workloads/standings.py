"""Facts, flags, dimensions and season standings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import add_result_flags, title_case
from stratalake.operators import join_sides, standings, union_labelled
from stratalake.plans.views import standings_sql
from stratalake.sinks import create_view
from workloads.registry import load, new_lake, query


def session_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as session results: shipped in a month, by a supplier, for a customer."""
    lines = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.year("l_shipdate").alias("season"),
        F.month("l_shipdate").alias("round"),
        F.col("l_suppkey").alias("constructor_id"),
        F.col("o_custkey").alias("driver_id"),
        F.col("l_linenumber").alias("final_position"),
        F.col("l_quantity").alias("points"),
    )


def constructor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows where no customer is needed, so without the orders join."""
    return load(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("season"),
        F.col("l_suppkey").alias("constructor_id"),
        F.col("l_linenumber").alias("final_position"),
        F.col("l_quantity").alias("points"),
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS driver_id", "c_name AS driver_name", "c_nationkey AS nation_key"
    )


def constructors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS constructor_id", "s_name AS constructor_name", "s_nationkey AS nation_key"
    )


def with_nationality(spark: SparkSession, sf_dir: str, ranked: DataFrame) -> DataFrame:
    """Replace the nation key by the nation's name, last, when few rows are left."""
    output = {
        "nationality" if name == "nation_key" else name: f"left.{name}" for name in ranked.columns
    }
    nations = load(spark, sf_dir, "nation")
    return join_sides(
        ranked,
        nations,
        {"nation_key": "n_nationkey"},
        output | {"nationality": "right.n_name"},
        how="left",
    )


SESSIONS_SQL = """
    SELECT year(l_shipdate)::INTEGER AS season, month(l_shipdate)::INTEGER AS round,
           l_suppkey AS constructor_id, o_custkey AS driver_id,
           l_linenumber AS final_position, l_quantity AS points
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
DRIVERS_SQL = """
    SELECT c_custkey AS driver_id, c_name AS driver_name, n_name AS nationality
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""
CONSTRUCTORS_SQL = """
    SELECT s_suppkey AS constructor_id, s_name AS constructor_name, n_name AS nationality
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
"""


def ranking_sql(sessions: str, dimension: str, entity: str, where: str = "") -> str:
    return f"""
        WITH totals AS (
            SELECT f.season, d.{entity}_id, d.{entity}_name, d.nationality,
                   count(*) AS race_starts, sum(f.points) AS total_points,
                   count(*) FILTER (WHERE f.final_position = 1) AS number_of_wins,
                   count(*) FILTER (WHERE f.final_position BETWEEN 1 AND 3) AS number_of_podiums
            FROM ({sessions}) f JOIN ({dimension}) d ON f.{entity}_id = d.{entity}_id
            GROUP BY ALL
        )
        SELECT * FROM (
            SELECT season, {entity}_id, {entity}_name, nationality,
                   (rank() OVER (PARTITION BY season ORDER BY total_points DESC NULLS LAST,
                                 number_of_wins DESC))::INTEGER AS standing,
                   race_starts, total_points, number_of_wins, number_of_podiums
            FROM totals
        ) {where}
    """


DRIVER_STANDINGS_SQL = ranking_sql(SESSIONS_SQL, DRIVERS_SQL, "driver")
CONSTRUCTOR_STANDINGS_SQL = ranking_sql(SESSIONS_SQL, CONSTRUCTORS_SQL, "constructor")


@query(DRIVER_STANDINGS_SQL)
def driver_standings(spark, sf_dir):
    fact = add_result_flags(session_rows(spark, sf_dir))
    ranked = standings(fact, drivers(spark, sf_dir), "driver_id", ["driver_name", "nation_key"])
    return with_nationality(spark, sf_dir, ranked)


@query(CONSTRUCTOR_STANDINGS_SQL)
def constructor_standings(spark, sf_dir):
    fact = add_result_flags(constructor_rows(spark, sf_dir))
    teams = constructors(spark, sf_dir)
    ranked = standings(fact, teams, "constructor_id", ["constructor_name", "nation_key"])
    return with_nationality(spark, sf_dir, ranked)


@query(DRIVER_STANDINGS_SQL)
def driver_standings_spread(spark, sf_dir):
    """The ranking that is used when a season has too many entities for one task."""
    fact = add_result_flags(session_rows(spark, sf_dir))
    ranked = standings(
        fact,
        drivers(spark, sf_dir),
        "driver_id",
        ["driver_name", "nation_key"],
        spread=True,
    )
    return with_nationality(spark, sf_dir, ranked)


@query(ranking_sql(SESSIONS_SQL, CONSTRUCTORS_SQL, "constructor", "WHERE season = 1998"))
def standings_one_season(spark, sf_dir):
    """A persisted view over tables, filtered; the filter reaches the scan."""
    lake = new_lake(spark, "one_season")
    fact, dimension = lake.name("gold", "lines"), lake.name("gold", "v_constructors")
    spark.catalog.createTable(fact, f"{sf_dir}/lineitem.parquet", "parquet")
    spark.catalog.createTable(lake.name("gold", "supplier"), f"{sf_dir}/supplier.parquet", "parquet")
    spark.catalog.createTable(lake.name("gold", "nation"), f"{sf_dir}/nation.parquet", "parquet")
    create_view(
        spark,
        lake.name("gold", "v_fact"),
        f"""SELECT year(l_shipdate) AS season, l_suppkey AS constructor_id, l_quantity AS points,
                   l_linenumber = 1 AS is_win, l_linenumber BETWEEN 1 AND 3 AS is_podium
            FROM {fact}""",
    )
    create_view(
        spark,
        dimension,
        f"""SELECT s_suppkey AS constructor_id, s_name AS constructor_name, n_name AS nationality
            FROM {lake.name("gold", "supplier")}
            LEFT JOIN {lake.name("gold", "nation")} ON s_nationkey = n_nationkey""",
    )
    view = lake.name("gold", "v_constructor_standing")
    create_view(spark, view, standings_sql(lake.name("gold", "v_fact"), dimension, "constructor"))
    return spark.sql(f"SELECT * FROM {view} WHERE season = 1998")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity AS points, 'RACE' AS session_type,
           l_linenumber = 1 AS is_win, l_linenumber BETWEEN 1 AND 3 AS is_podium,
           l_quantity > 0 AS has_points
    FROM lineitem WHERE l_linestatus = 'O'
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_quantity, 'SPRINT',
           l_linenumber = 1, l_linenumber BETWEEN 1 AND 3, l_quantity > 0
    FROM lineitem WHERE l_linestatus = 'F'
    """
)
def fact_sessions(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("points"), "l_linestatus"
    )
    sessions = {
        "RACE": lines.where(F.col("l_linestatus") == "O"),
        "SPRINT": lines.where(F.col("l_linestatus") == "F"),
    }
    fact = union_labelled(sessions, "session_type", drop=("l_linestatus",))
    return add_result_flags(fact, position="l_linenumber")


NULLABLE_SQL = """
    SELECT l_orderkey, l_suppkey, nullif(l_linenumber, 7) AS final_position,
           nullif(l_quantity, 50) AS points FROM lineitem
"""


def _nullable(spark, sf_dir):
    return add_result_flags(
        load(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_suppkey",
            F.nullif("l_linenumber", F.lit(7)).alias("final_position"),
            F.nullif("l_quantity", F.lit(50.0)).alias("points"),
        )
    )


@query(
    f"""
    SELECT *, final_position = 1 AS is_win, final_position BETWEEN 1 AND 3 AS is_podium,
           points > 0 AS has_points
    FROM ({NULLABLE_SQL})
    """
)
def fact_flags_nullable(spark, sf_dir):
    return _nullable(spark, sf_dir)


@query(
    f"""
    SELECT l_suppkey, final_position, count(*) AS starts, sum(points) AS total_points,
           count(*) FILTER (WHERE final_position = 1) AS wins,
           count(*) FILTER (WHERE final_position BETWEEN 1 AND 3) AS podiums
    FROM ({NULLABLE_SQL}) GROUP BY ALL
    """
)
def count_if_all_null(spark, sf_dir):
    """Groups whose flag is null throughout count zero."""
    return (
        _nullable(spark, sf_dir)
        .groupBy("l_suppkey", "final_position")
        .agg(
            F.count(F.lit(1)).alias("starts"),
            F.sum("points").alias("total_points"),
            F.count_if("is_win").alias("wins"),
            F.count_if("is_podium").alias("podiums"),
        )
    )


@query(
    """
    SELECT o_orderkey, o_orderdate, c_name AS customer_name, c_mktsegment
    FROM orders JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY')
      ON o_custkey = c_custkey
    """
)
def dim_inner(spark, sf_dir):
    """Orders of unknown customers are dropped."""
    return join_sides(
        load(spark, sf_dir, "orders"),
        load(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'"),
        {"o_custkey": "c_custkey"},
        {
            "o_orderkey": "left.o_orderkey",
            "o_orderdate": "left.o_orderdate",
            "customer_name": "right.c_name",
            "c_mktsegment": "right.c_mktsegment",
        },
    )


@query(
    """
    SELECT c_custkey, c_name, n.n_name AS nationality, n.r_name AS nationality_region
    FROM customer LEFT JOIN (
        SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
        WHERE r_name <> 'ASIA'
    ) n ON c_nationkey = n_nationkey
    """
)
def dim_left_lookup(spark, sf_dir):
    """Customers whose nation is missing from the look-up keep a null region."""
    nations = join_sides(
        load(spark, sf_dir, "nation"),
        load(spark, sf_dir, "region").where("r_name <> 'ASIA'"),
        {"n_regionkey": "r_regionkey"},
        {"key": "left.n_nationkey", "nation": "left.n_name", "region": "right.r_name"},
    )
    return join_sides(
        load(spark, sf_dir, "customer"),
        nations,
        {"c_nationkey": "key"},
        {
            "c_custkey": "left.c_custkey",
            "c_name": "left.c_name",
            "nationality": "right.nation",
            "nationality_region": "right.region",
        },
        how="left",
    )


LANGUAGES = [("en", "English", "Germanic"), ("de", "German", "Germanic"), ("fr", "French", "Romance")]
_LANGUAGE_VALUES = ", ".join(str(row) for row in LANGUAGES)


@query(
    f"""
    SELECT lang, language, family, count(*) AS documents, sum(n_chars)::BIGINT AS characters
    FROM documents LEFT JOIN (VALUES {_LANGUAGE_VALUES}) v(code, language, family) ON lang = code
    GROUP BY ALL
    """
)
def literal_lookup(spark, sf_dir):
    """A look-up given as literal rows; unknown languages stay with nulls."""
    lookup = spark.createDataFrame(LANGUAGES, "code string, language string, family string")
    return (
        join_sides(
            load(spark, sf_dir, "documents"),
            lookup,
            {"lang": "code"},
            {
                "lang": "left.lang",
                "n_chars": "left.n_chars",
                "language": "right.language",
                "family": "right.family",
            },
            how="left",
        )
        .groupBy("lang", "language", "family")
        .agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("characters"))
    )


@query(
    """
    SELECT o_orderkey, array_to_string(list_transform(string_split(lower(o_orderpriority), ' '),
               lambda x: upper(x[1]) || x[2:]), ' ') AS o_orderpriority,
           array_to_string(list_transform(string_split(lower(c_name || ' OF ' || c_mktsegment), ' '),
               lambda x: upper(x[1]) || x[2:]), ' ') AS customer
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    name="title_case",
)
def title_case_text(spark, sf_dir):
    rows = join_sides(
        load(spark, sf_dir, "orders"),
        load(spark, sf_dir, "customer").withColumn(
            "label", F.concat("c_name", F.lit(" OF "), "c_mktsegment")
        ),
        {"o_custkey": "c_custkey"},
        {
            "o_orderkey": "left.o_orderkey",
            "o_orderpriority": "left.o_orderpriority",
            "customer": "right.label",
        },
    )
    return title_case(rows, ["o_orderpriority", "customer"])


@query(
    """
    SELECT season, driver_id, driver_name, standing, race_starts, total_points, number_of_wins, number_of_podiums
    FROM (SELECT *, (rank() OVER (PARTITION BY season ORDER BY total_points DESC, number_of_wins DESC))::INTEGER AS standing
          FROM (SELECT year(l_shipdate)::INTEGER AS season, c_custkey AS driver_id, c_name AS driver_name,
                       count(*) AS race_starts, sum((l_quantity / 4)::FLOAT::DOUBLE) AS total_points,
                       count(*) FILTER (WHERE l_linenumber = 1) AS number_of_wins,
                       count(*) FILTER (WHERE l_linenumber <= 3) AS number_of_podiums
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
                GROUP BY ALL))
    """
)
def points_float_sum(spark, sf_dir):
    """Points kept in single precision, with fractions: totals are exact and equal totals tie."""
    rows = session_rows(spark, sf_dir).withColumn("points", (F.col("points") / 4).cast("float"))
    return standings(add_result_flags(rows), drivers(spark, sf_dir), "driver_id", ["driver_name"])

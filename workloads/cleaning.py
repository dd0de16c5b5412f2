"""Projections, filters, de-duplication and whole cleaning specs."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.functions import full_name
from stratalake.operators import ConformSpec, any_per_key, conform, first_per_key, removed_rows
from stratalake.operators.conform import keys_present, shape
from workloads.registry import load, query

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"]


@query("SELECT p_partkey AS part_id, p_name AS part_name, p_retailprice AS price FROM part")
def rename_project(spark, sf_dir):
    spec = ConformSpec(
        keys=("part_id",),
        columns=("p_partkey", "p_name", "p_retailprice"),
        renames={"p_partkey": "part_id", "p_name": "part_name", "p_retailprice": "price"},
    )
    return shape(load(spark, sf_dir, "part"), spec)


@query("SELECT o_orderkey AS order_id, o_custkey, o_orderdate FROM orders")
def drop_columns(spark, sf_dir):
    spec = ConformSpec(
        keys=("order_id",),
        drop=("o_orderstatus", "o_totalprice", "o_orderpriority"),
        renames={"o_orderkey": "order_id"},
    )
    return shape(load(spark, sf_dir, "orders"), spec)


def _gappy_orders(spark, sf_dir):
    """Orders with key columns that are null for some customers and priorities."""
    return load(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("customer_id"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        "o_orderkey",
        "o_totalprice",
    )


GAPPY_SQL = """
    SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS customer_id,
           nullif(o_orderstatus, 'P') AS status, o_orderkey, o_totalprice
    FROM orders
"""


@query(
    f"SELECT * FROM ({GAPPY_SQL}) WHERE customer_id IS NOT NULL AND status IS NOT NULL"
)
def require_keys(spark, sf_dir):
    return _gappy_orders(spark, sf_dir).where(keys_present(["customer_id", "status"]))


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedupe_keys(spark, sf_dir):
    """Any survivor per key; only the keys are compared."""
    return any_per_key(load(spark, sf_dir, "lineitem"), LINE_KEYS).select(*LINE_KEYS)


@query(
    f"""
    SELECT {", ".join(LINE_KEYS + LINE_ORDER)} FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY {", ".join(LINE_KEYS)}
                               ORDER BY {", ".join(LINE_ORDER)}) = 1
    """
)
def dedupe_deterministic(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select(*LINE_KEYS, *LINE_ORDER)
    return first_per_key(lines, LINE_KEYS, LINE_ORDER)


@query(
    f"""
    SELECT customer_id, status, o_orderkey, o_totalprice FROM ({GAPPY_SQL})
    QUALIFY row_number() OVER (PARTITION BY customer_id, status ORDER BY o_orderkey) = 1
    """
)
def dedupe_null_key(spark, sf_dir):
    """Null keys form one group, however many rows they hold."""
    return first_per_key(_gappy_orders(spark, sf_dir), ["customer_id", "status"], ["o_orderkey"])


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    return lines.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query(
    f"""
    SELECT count(*) AS rows_in,
           count(*) FILTER (WHERE NOT ok) AS invalid_rows,
           count(*) FILTER (WHERE ok) - count(DISTINCT CASE WHEN ok THEN (customer_id, status) END)
               AS duplicate_rows,
           count(*) - count(DISTINCT CASE WHEN ok THEN (customer_id, status) END) AS removed_rows,
           count(DISTINCT CASE WHEN ok THEN (customer_id, status) END) AS rows_out
    FROM (SELECT *, customer_id IS NOT NULL AND status IS NOT NULL AS ok FROM ({GAPPY_SQL}))
    """
)
def audit_removed_rows(spark, sf_dir):
    return removed_rows(_gappy_orders(spark, sf_dir), ["customer_id", "status"])


@query(
    """
    SELECT p_partkey, array_to_string(list_transform(string_split(lower(
               concat_ws(' ', nullif(p_type, 'ECONOMY'), nullif(p_brand, 'Brand#4'))), ' '),
               lambda x: upper(x[1]) || x[2:]), ' ') AS part_label
    FROM part
    """,
    name="full_name",
)
def full_name_text(spark, sf_dir):
    """Null parts are skipped; nothing left gives an empty string."""
    parts = load(spark, sf_dir, "part").select(
        "p_partkey",
        F.nullif("p_type", F.lit("ECONOMY")).alias("kind"),
        F.nullif("p_brand", F.lit("Brand#4")).alias("brand"),
    )
    return parts.select("p_partkey", full_name("kind", "brand").alias("part_label"))


@query("SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 100000")
def sql_string_filter(spark, sf_dir):
    return load(spark, sf_dir, "orders").where(
        "o_orderpriority = '1-URGENT' AND o_totalprice > 100000"
    )


@query("SELECT * FROM orders WHERE o_orderstatus IN ('O', 'P')")
def isin_filter(spark, sf_dir):
    return load(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("O", "P"))


# One cleaning spec per shape the racing datasets use, on tables of the same shape.

SUPPLIER_SPEC = ConformSpec(
    keys=("circuit_id",),
    checked_keys=("circuit_id",),
    columns=("s_suppkey", "s_name", "s_acctbal", "s_nationkey"),
    renames={
        "s_suppkey": "circuit_id", "s_name": "circuit_name",
        "s_acctbal": "latitude", "s_nationkey": "locality_id",
    },
    title=("circuit_name",),
)


@query(
    """
    SELECT s_suppkey AS circuit_id, s_name AS circuit_name, s_acctbal + 1 AS latitude,
           s_nationkey AS locality_id
    FROM supplier
    """
)
def conform_circuits(spark, sf_dir):
    """Single key, rename, title case; every supplier arrives twice, once in capitals and further
    north.  Capitals come first in the order of duplicates."""
    suppliers = load(spark, sf_dir, "supplier")
    shouting = suppliers.withColumns({"s_name": F.upper("s_name"), "s_acctbal": F.col("s_acctbal") + 1})
    return conform(suppliers.unionByName(shouting), SUPPLIER_SPEC)


RACE_SPEC = ConformSpec(
    keys=("season", "round"),
    columns=("season", "round", "raceName", "date", "circuitId"),
    renames={"raceName": "race_name", "date": "race_date", "circuitId": "circuit_id"},
    title=("race_name",),
)


@query(
    """
    SELECT year(l_shipdate)::INTEGER AS season, month(l_shipdate)::INTEGER AS round,
           'Ships In ' || strftime(l_shipdate, '%Y-%m-%d') AS race_name,
           strftime(l_shipdate, '%Y-%m-%d') AS race_date, l_suppkey AS circuit_id
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY year(l_shipdate), month(l_shipdate)
                               ORDER BY l_shipdate, l_suppkey) = 1
    """
)
def conform_races(spark, sf_dir):
    """Few keys with very many duplicates each: the first shipment of every month."""
    rows = load(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("season"),
        F.month("l_shipdate").alias("round"),
        F.concat(F.lit("ships in "), F.col("l_shipdate").cast("date").cast("string")).alias("raceName"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").alias("circuitId"),
    )
    return conform(rows, RACE_SPEC).withColumn("race_date", F.col("race_date").cast("string"))


CUSTOMER_SPEC = ConformSpec(
    keys=("driver_id",),
    drop=("url",),
    renames={"driverId": "driver_id"},
    names={"driver_name": ("name.givenName", "name.familyName")},
    title=("nationality",),
)


@query(
    """
    SELECT c_custkey AS driver_id, segment[1] || lower(segment[2:]) AS nationality,
           concat_ws(' ', 'Customer', nullif(c_name[10:], '000000007')) AS driver_name
    FROM (SELECT *, least(c_mktsegment, reverse(c_mktsegment)) AS segment FROM customer)
    """
)
def conform_drivers(spark, sf_dir):
    """A nested name is flattened; one customer lacks a family name.  Every customer arrives twice,
    once with the segment spelled backwards; the first in text order stays."""
    rows = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("driverId"),
        F.struct(
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("givenName"),
            F.nullif(F.split_part("c_name", F.lit("#"), F.lit(2)), F.lit("000000007")).alias("familyName"),
        ).alias("name"),
        F.col("c_mktsegment").alias("nationality"),
        F.lit("none").alias("url"),
    )
    backwards = rows.withColumn("nationality", F.reverse("nationality"))
    return conform(rows.unionByName(backwards), CUSTOMER_SPEC)


RESULT_SPEC = ConformSpec(
    keys=("season", "constructor_id", "position"),
    checked_keys=("season", "constructor_id", "position"),
    columns=("season", "constructorId", "position", "points", "status"),
    renames={"constructorId": "constructor_id", "points": "scored"},
    title=("status",),
)


@query(
    """
    SELECT year(l_shipdate)::INTEGER AS season, l_suppkey AS constructor_id,
           nullif(l_linenumber, 7) AS position, l_quantity AS scored, l_returnflag AS status
    FROM lineitem WHERE l_linenumber <> 7
    QUALIFY row_number() OVER (PARTITION BY year(l_shipdate), l_suppkey, l_linenumber
                               ORDER BY l_quantity, l_returnflag) = 1
    """
)
def conform_results(spark, sf_dir):
    """Composite key with nulls and duplicates."""
    rows = load(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("season"),
        F.col("l_suppkey").alias("constructorId"),
        F.nullif("l_linenumber", F.lit(7)).alias("position"),
        F.col("l_quantity").alias("points"),
        F.lower("l_returnflag").alias("status"),
    )
    return conform(rows, RESULT_SPEC)

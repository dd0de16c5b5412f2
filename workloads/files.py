"""Landing-file reads: each query writes a table's rows as files and reads them strictly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import (
    add_ingestion_metadata,
    full_name,
    stamp_batch,
    stamp_write_times,
)
from stratalake.sources import batch_path, landing_batches, read_csv, read_json
from stratalake.storage import scratch_dir
from workloads.registry import load, query

ORDER_COLUMNS = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate DATE, o_orderpriority STRING"
ORDERS_SQL = """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate::DATE::VARCHAR AS o_orderdate, o_orderpriority
"""


def _orders(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderpriority",
    )


def _source_folder() -> Column:
    """Name of the folder the row's file was in (file names are generated)."""
    return F.element_at(F.split("source_file", "/"), -2).alias("source_folder")


@query(f"{ORDERS_SQL}, 'orders.csv' AS source_folder FROM orders")
def csv_roundtrip(spark, sf_dir):
    path = f"{scratch_dir(spark, 'csv')}/orders.csv"
    _orders(spark, sf_dir).write.csv(path, header=True)
    rows = add_ingestion_metadata(read_csv(spark, path, ORDER_COLUMNS))
    return rows.select(*rows.columns[:5], _source_folder()).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("string")
    )


@query(f"{ORDERS_SQL}, 'orders.json' AS source_folder FROM orders")
def json_roundtrip(spark, sf_dir):
    path = f"{scratch_dir(spark, 'json')}/orders.json"
    _orders(spark, sf_dir).write.json(path)
    rows = add_ingestion_metadata(read_json(spark, path, ORDER_COLUMNS))
    return rows.select(*rows.columns[:5], _source_folder()).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("string")
    )


@query(
    """
    SELECT c_custkey, concat_ws(' ', 'Customer', c_name[10:]) AS customer_name, c_acctbal
    FROM customer
    """
)
def json_nested_flatten(spark, sf_dir):
    path = f"{scratch_dir(spark, 'nested')}/customers.json"
    load(spark, sf_dir, "customer").select(
        "c_custkey",
        F.struct(
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("givenName"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("familyName"),
        ).alias("name"),
        "c_acctbal",
    ).write.json(path)
    schema = "c_custkey BIGINT, name STRUCT<givenName: STRING, familyName: STRING>, c_acctbal DOUBLE"
    return read_json(spark, path, schema).select(
        "c_custkey", full_name("name.givenName", "name.familyName").alias("customer_name"), "c_acctbal"
    )


def write_json_documents(rows: DataFrame, path: str, compression: str = "none") -> None:
    """Files holding one JSON array each, spread over lines.  A document is one Arrow
    batch of a task, so its size is bounded and nothing is shuffled."""

    # Nested, so that Spark ships it by value: executors need not have this module.
    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = "[\n" + ",\n".join(batch["row"]) + "\n]"
            yield pd.DataFrame({"value": [text]})

    as_json = rows.select(F.to_json(F.struct(*rows.columns)).alias("row"))
    written = as_json.mapInPandas(documents, "value string")
    written.write.option("maxRecordsPerFile", 1).text(path, compression=compression)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_multiline_folder(spark, sf_dir):
    path = scratch_dir(spark, "documents")
    customers = load(spark, sf_dir, "customer")
    write_json_documents(customers, path)
    schema = (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    )
    return read_json(spark, path, schema, multi_line=True)


EVENT_COLUMNS = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"


@query(
    """
    SELECT event_id, user_id, event_type, value,
           '2024-01-' || CASE WHEN day(ts) <= 10 THEN '10' WHEN day(ts) <= 20 THEN '20' ELSE '31' END
               AS batch_id
    FROM events
    """
)
def batch_folder_scan(spark, sf_dir):
    """One landing folder per batch, found by listing, read one by one and stamped."""
    landing, day = scratch_dir(spark, "landing"), F.dayofmonth("ts")
    last_day = F.when(day <= 10, "10").when(day <= 20, "20").otherwise("31")
    events = load(spark, sf_dir, "events").withColumn("last_day", last_day)
    for name in ("10", "20", "31"):
        events.where(F.col("last_day") == name).select(
            "event_id", "user_id", "event_type", "value"
        ).write.json(batch_path(landing, f"2024-01-{name}", "events"))
    scans = [
        stamp_batch(read_json(spark, batch_path(landing, name, "events"), EVENT_COLUMNS), name)
        for name in landing_batches(spark, landing)
    ]
    return reduce(DataFrame.unionByName, scans)


@query(
    """
    SELECT o_orderpriority, 'orders.json' AS source_folder, '2025-01' AS batch_id,
           count(*) AS orders, count(*) AS stamped, 1::BIGINT AS load_times, count(*) AS same_times
    FROM orders GROUP BY ALL
    """
)
def lineage_columns(spark, sf_dir):
    """Source file, batch and times are set on every row; the times are one per query."""
    path = f"{scratch_dir(spark, 'lineage')}/orders.json"
    _orders(spark, sf_dir).write.json(path)
    scan = add_ingestion_metadata(read_json(spark, path, ORDER_COLUMNS))
    rows = stamp_write_times(stamp_batch(scan, "2025-01"))
    return rows.groupBy("o_orderpriority", _source_folder(), "batch_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("ingestion_timestamp").alias("stamped"),
        F.count_distinct("ingestion_timestamp").alias("load_times"),
        F.count_if(F.col("created_timestamp") == F.col("updated_timestamp")).alias("same_times"),
    )

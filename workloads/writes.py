"""Table writes: overwrite, append, partition replace and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import stamp_write_times
from stratalake.operators import first_per_key
from stratalake.plans.incremental import NOT_OLDER
from stratalake.plans.stages import of_batch
from stratalake.sinks import (
    TableLayout,
    append,
    delete_all,
    insert_values,
    overwrite,
    replace_partition,
    upsert,
)
from workloads.registry import load, new_lake, query

PEOPLE_SQL = """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_acctbal FROM supplier
"""


def _people(spark, sf_dir) -> list[DataFrame]:
    return [
        load(spark, sf_dir, table).selectExpr(
            f"{p}_{key} AS id", f"{p}_name AS name", f"{p}_acctbal AS balance"
        )
        for table, p, key in (("customer", "c", "custkey"), ("supplier", "s", "suppkey"))
    ]


@query(PEOPLE_SQL)
def append_rows(spark, sf_dir):
    lake = new_lake(spark, "append")
    name = lake.name("silver", "people")
    for rows in _people(spark, sf_dir):
        append(rows, name)
    return spark.table(name)


@query("SELECT s_suppkey AS id, s_name AS name, s_acctbal + 1 AS balance FROM supplier")
def overwrite_table(spark, sf_dir):
    """Overwritten twice, the second time from its own content."""
    lake = new_lake(spark, "overwrite")
    name = lake.name("silver", "people")
    customers, suppliers = _people(spark, sf_dir)
    overwrite(customers, name)
    overwrite(suppliers, name)
    overwrite(spark.table(name).withColumn("balance", F.col("balance") + 1), name)
    return spark.table(name)


@query(
    "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier", name="delete_all"
)
def delete_all_rows(spark, sf_dir):
    """Emptied, then usable again."""
    lake = new_lake(spark, "delete")
    name = lake.name("silver", "people")
    customers, suppliers = _people(spark, sf_dir)
    overwrite(customers, name)
    delete_all(spark, name)
    append(suppliers, name)
    return spark.table(name)


def _orders_by_year(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy").alias("batch_id"),
    )


YEARS_SQL = "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y') AS batch_id FROM orders"
BY_BATCH = TableLayout(partition_by="batch_id")


def _replace_1997(spark, sf_dir, label: str, rows) -> DataFrame:
    lake = new_lake(spark, label)
    name = lake.name("bronze", "orders")
    orders = _orders_by_year(spark, sf_dir)
    overwrite(orders, name, BY_BATCH)
    replace_partition(rows(orders).drop("batch_id"), name, "batch_id", "1997")
    return spark.table(name)


@query(
    f"""
    SELECT * FROM ({YEARS_SQL}) WHERE batch_id <> '1997'
    UNION ALL
    SELECT o_orderkey, o_totalprice * 2, '1997' FROM ({YEARS_SQL}) WHERE batch_id IN ('1997', '1998')
    """,
    name="replace_partition",
)
def replace_batch_partition(spark, sf_dir):
    """The batch is loaded again with other rows; the other batches stay."""
    return _replace_1997(
        spark,
        sf_dir,
        "replace",
        lambda orders: orders.where(F.col("batch_id").isin("1997", "1998")).withColumn(
            "o_totalprice", F.col("o_totalprice") * 2
        ),
    )


@query(
    f"SELECT * FROM ({YEARS_SQL}) WHERE batch_id <> '1997'", name="replace_partition_empty"
)
def replace_batch_partition_empty(spark, sf_dir):
    """A batch without rows empties its partition."""
    return _replace_1997(
        spark, sf_dir, "replace_empty", lambda orders: orders.where(F.lit(False))
    )


@query(f"SELECT * FROM ({YEARS_SQL}) WHERE batch_id = '1997'")
def batch_filter(spark, sf_dir):
    """One batch of a table partitioned by batch: only its partition is read."""
    name = new_lake(spark, "batch_filter").name("bronze", "orders")
    overwrite(_orders_by_year(spark, sf_dir), name, BY_BATCH)
    return of_batch(spark.table(name), "1997")


# -- upserts: the last event of every user per batch of ten days ---------------------------

BATCHES_SQL = """
    SELECT user_id, event_type, value, batch_id, batch_id AS first_batch
    FROM (SELECT *, CASE WHEN day(ts) <= 10 THEN '2024-01-10' WHEN day(ts) <= 20 THEN '2024-01-20'
                    ELSE '2024-01-31' END AS batch_id FROM events)
    QUALIFY row_number() OVER (PARTITION BY batch_id, user_id ORDER BY ts DESC, event_id DESC) = 1
"""
LATEST_PREFERRED = "batch_id DESC"


def _merged_sql(preference: str) -> str:
    """The row per user that wins, with the batch that inserted the user first."""
    return f"""
        SELECT user_id, event_type, value, batch_id, loaded_first AS first_batch FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {preference}) AS n,
                   arg_min(batch_id, CASE batch_id WHEN '2024-01-10' THEN 1 WHEN '2024-01-31' THEN 2
                                     ELSE 3 END) OVER (PARTITION BY user_id) AS loaded_first
            FROM ({BATCHES_SQL})) WHERE n = 1
    """


def event_batches(spark, sf_dir) -> DataFrame:
    """Last event per batch and user; ``first_batch`` never changes after the insert."""
    day = F.dayofmonth("ts")
    batch = F.when(day <= 10, "2024-01-10").when(day <= 20, "2024-01-20").otherwise("2024-01-31")
    rows = load(spark, sf_dir, "events").withColumn("batch_id", batch)
    latest = first_per_key(
        rows, ["batch_id", "user_id"], [F.col("ts").desc(), F.col("event_id").desc()]
    )
    return latest.select(
        "user_id", "event_type", "value", "batch_id", F.col("batch_id").alias("first_batch")
    )


UPDATED = ["event_type", "value", "batch_id"]
# The second batch arrives last.
LATE_ORDER = ("2024-01-10", "2024-01-31", "2024-01-20")


def _upsert_all(spark, sf_dir, label: str, order=LATE_ORDER, **options) -> DataFrame:
    lake = new_lake(spark, label)
    name, events = lake.name("silver", "users"), event_batches(spark, sf_dir)
    for batch_id in order:
        batch = events.where(F.col("batch_id") == batch_id)
        upsert(
            stamp_write_times(batch),
            name,
            keys=["user_id"],
            update=[*UPDATED, "updated_timestamp"],
            unique_source=True,
            **options,
        )
    return spark.table(name).drop("created_timestamp", "updated_timestamp")


@query(_merged_sql(LATEST_PREFERRED))
def upsert_guarded(spark, sf_dir):
    """Whatever the order of arrival, the newest batch of each user wins."""
    return _upsert_all(spark, sf_dir, "guarded", guard=NOT_OLDER)


@query(_merged_sql(LATEST_PREFERRED))
def upsert_guarded_large_source(spark, sf_dir):
    """The same through the full outer join that large sources take."""
    return _upsert_all(spark, sf_dir, "guarded_large", guard=NOT_OLDER, small_source=False)


@query(_merged_sql(LATEST_PREFERRED))
def upsert_guarded_small_source(spark, sf_dir):
    """The same through the join that leaves the target in place."""
    return _upsert_all(spark, sf_dir, "guarded_small", guard=NOT_OLDER, small_source=True)


@query(_merged_sql(LATEST_PREFERRED))
def upsert_bucketed(spark, sf_dir):
    """The same on a table bucketed by its key, which the merge reads without a shuffle."""
    layout = TableLayout(bucket_by=("user_id",), buckets=8)
    return _upsert_all(spark, sf_dir, "bucketed", guard=NOT_OLDER, layout=layout)


@query(_merged_sql(LATEST_PREFERRED))
def upsert_old_batch_rerun(spark, sf_dir):
    """Batches are run again after newer ones; nothing goes back in time."""
    order = (*LATE_ORDER, "2024-01-10", "2024-01-20")
    return _upsert_all(spark, sf_dir, "rerun", order=order, guard=NOT_OLDER)


@query(
    _merged_sql(
        "CASE batch_id WHEN '2024-01-20' THEN 1 WHEN '2024-01-31' THEN 2 ELSE 3 END"
    )
)
def upsert_unguarded(spark, sf_dir):
    """Without a guard the batch that arrives last wins."""
    return _upsert_all(spark, sf_dir, "unguarded")


@query(
    f"""
    WITH b AS ({BATCHES_SQL}),
    one AS (SELECT * FROM b WHERE batch_id = '2024-01-10'),
    two AS (
        SELECT t.user_id, coalesce(s.event_type, t.event_type) AS event_type,
               coalesce(s.value, t.value) AS value, coalesce(s.batch_id, t.batch_id) AS batch_id, t.first_batch
        FROM one t LEFT JOIN (SELECT * FROM b WHERE batch_id = '2024-01-20') s
          ON t.user_id = s.user_id AND t.event_type <> 'click')
    SELECT t.user_id, coalesce(s.event_type, t.event_type) AS event_type,
           coalesce(s.value, t.value) AS value, coalesce(s.batch_id, t.batch_id) AS batch_id, t.first_batch
    FROM two t LEFT JOIN (SELECT * FROM b WHERE batch_id = '2024-01-31') s
      ON t.user_id = s.user_id AND t.event_type <> 'click'
    """
)
def upsert_update_only(spark, sf_dir):
    """Existing users change unless their last event was a click; no user is added."""
    lake = new_lake(spark, "update_only")
    name, events = lake.name("silver", "users"), event_batches(spark, sf_dir)
    overwrite(events.where("batch_id = '2024-01-10'"), name)
    for batch_id in ("2024-01-20", "2024-01-31"):
        upsert(
            events.where(F.col("batch_id") == batch_id),
            name,
            keys=["user_id"],
            update=UPDATED,
            match="t.event_type <> 'click'",
            insert=False,
        )
    return spark.table(name)


@query(
    f"""
    WITH b AS (SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN user_id END AS user_id)
               FROM ({BATCHES_SQL})),
         last AS (
             SELECT * FROM b WHERE user_id IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY batch_id DESC) = 1)
    SELECT l.* REPLACE (f.first_batch AS first_batch) FROM last l
    JOIN (SELECT user_id, min(first_batch) AS first_batch FROM b GROUP BY user_id) f USING (user_id)
    UNION ALL
    SELECT * FROM b WHERE user_id IS NULL
    UNION ALL
    SELECT * FROM b WHERE user_id IS NULL AND batch_id > '2024-01-10'
    """
)
def upsert_null_keys(spark, sf_dir):
    """A null key never matches, so loading a batch twice adds its null-key rows twice."""
    lake = new_lake(spark, "null_keys")
    name = lake.name("silver", "users")
    events = event_batches(spark, sf_dir).withColumn(
        "user_id", F.when(F.col("event_type") != "error", F.col("user_id"))
    )
    overwrite(events.where("batch_id = '2024-01-10'"), name)
    for batch_id in ("2024-01-20", "2024-01-20", "2024-01-31", "2024-01-31"):
        upsert(
            events.where(F.col("batch_id") == batch_id), name, keys=["user_id"], update=UPDATED,
            guard=NOT_OLDER,
        )
    return spark.table(name)


@query(
    """
    SELECT year(o_orderdate)::INTEGER AS order_year, o_orderkey,
           CASE WHEN year(o_orderdate) IN (1996, 1997) AND o_orderstatus <> 'P'
                THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
    FROM orders
    """
)
def upsert_partitioned(spark, sf_dir):
    """Corrections for two years, some of them new orders: only two partitions are rewritten."""
    lake = new_lake(spark, "partitioned")
    name = lake.name("gold", "orders")
    orders = load(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("order_year"),
        "o_orderkey",
        "o_totalprice",
        "o_orderpriority",
        "o_orderstatus",
    )
    columns = ["order_year", "o_orderkey", "o_totalprice"]
    corrected = F.expr("order_year IN (1996, 1997) AND o_orderstatus <> 'P'")
    new = corrected & (F.col("o_orderpriority") == "1-URGENT")
    overwrite(orders.where(~new).select(*columns), name, TableLayout(partition_by="order_year"))
    corrections = orders.where(corrected).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    upsert(
        corrections.select(*columns),
        name,
        keys=["order_year", "o_orderkey"],
        update=["o_totalprice"],
    )
    return spark.table(name).select(*columns)


@query(
    """
    SELECT year(o_orderdate)::INTEGER AS order_year, month(o_orderdate)::INTEGER AS order_month,
           o_orderkey, CASE WHEN month(o_orderdate) IN (2, 7) AND year(o_orderdate) > 1996
                            THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
    FROM orders
    """
)
def upsert_partitioned_pair(spark, sf_dir):
    """Partitions by year and month: corrections of two months a year rewrite these months only."""
    name = new_lake(spark, "partitioned_pair").name("gold", "orders")
    columns = ["order_year", "order_month", "o_orderkey", "o_totalprice"]
    orders = load(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("order_year"), F.month("o_orderdate").alias("order_month"),
        "o_orderkey", "o_totalprice",
    )
    overwrite(orders, name, TableLayout(partition_by=("order_year", "order_month")))
    corrections = orders.where("order_month IN (2, 7) AND order_year > 1996").withColumn(
        "o_totalprice", -F.col("o_totalprice")
    )
    upsert(corrections, name, keys=columns[:3], update=["o_totalprice"], unique_source=True)
    return spark.table(name).select(*columns)


@query(
    """
    SELECT r_regionkey::BIGINT AS r_regionkey, r_name FROM region
    UNION ALL VALUES (100::BIGINT, 'ATLANTIS'), (101::BIGINT, 'O''HIGGINS')
    """
)
def insert_literal_rows(spark, sf_dir):
    """Rows given as SQL text, added to a table with rows of its own."""
    name = new_lake(spark, "literals").name("control", "regions")
    regions = load(spark, sf_dir, "region")
    overwrite(regions.select(F.col("r_regionkey").cast("long").alias("r_regionkey"), "r_name"), name)
    insert_values(spark, name, "(100, 'ATLANTIS')", "(101, 'O\\'HIGGINS')")
    return spark.table(name)

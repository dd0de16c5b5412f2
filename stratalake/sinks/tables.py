"""Rerunnable table writes on plain parquet tables of the session catalog.

Every write that replaces data goes to a new folder below the table's root; the
catalog is pointed at it only after the files are complete (``ALTER TABLE ...
SET LOCATION``, per partition where the table is partitioned).  So a table may be
read while its next version is computed from it, a failed job changes nothing,
and a retried one simply writes another folder.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.operators.merge import AMBIGUOUS, REPEATED, merge_rows
from stratalake.storage import delete_folder, list_folders, staged_files

# An upsert that reaches more partitions than this rearranges its rows by partition before
# writing; otherwise every task would write a small file into each of them.
PARTITIONS_PER_WRITING_TASK = 4
# Tasks of a large write fill good files in that many partitions each, so its rows stay where they are.
PARTITIONS_PER_LARGE_TASK = 16
PARTITIONS_PER_CALL = 500  # partitions added by one catalog statement
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Values Spark writes into folder names as they are.
_PLAIN_VALUE = re.compile(r"[A-Za-z0-9_. -]+")


@dataclass(frozen=True)
class TableLayout:
    """Physical layout.

    ``partition_by``, a column or several, should be part of the merge key: an upsert then rewrites
    only the partitions its source touches.  Bucketing by the (other) key columns
    lets the merge join read the target without shuffling it.
    """

    partition_by: str | tuple[str, ...] | None = None
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    @property
    def partition_columns(self) -> tuple[str, ...]:
        if isinstance(self.partition_by, str):
            return (self.partition_by,)
        return self.partition_by or ()


PLAIN = TableLayout()


# -- schemas, tables, views ---------------------------------------------------------------


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """Create the schema if absent, optionally with its own storage folder."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{at}")


def _root(spark: SparkSession, name: str) -> str:
    """Folder below which all versions of a table live."""
    schema, table = name.rsplit(".", 1)
    return f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{table}"


def _new_version(spark: SparkSession, name: str) -> str:
    return f"{_root(spark, name)}/v{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"


def _columns_ddl(schema: StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def ensure_table(
    spark: SparkSession,
    name: str,
    columns: StructType | str,
    layout: TableLayout = PLAIN,
    location: str | None = None,
) -> None:
    """Create an empty table if absent."""
    ddl = columns if isinstance(columns, str) else _columns_ddl(columns)
    names = ", ".join(f"`{column}`" for column in layout.partition_columns)
    partitioned = f"PARTITIONED BY ({names})" if names else ""
    bucketed = ""
    if layout.bucket_by:
        names = ", ".join(f"`{column}`" for column in layout.bucket_by)
        bucketed = f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {layout.buckets} BUCKETS"
    location = location or _new_version(spark, name)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
        f"{partitioned} {bucketed} LOCATION '{location}'"
    )


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """Create or replace a persisted view."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def _same_columns(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the column order of the table; other names or types are an error."""
    table = df.sparkSession.table(name).schema
    want = {field.name: field.dataType for field in table}
    have = {field.name: field.dataType for field in df.schema}
    if want != have:
        wrong = sorted(k for k in want.keys() | have.keys() if want.get(k) != have.get(k))
        raise ValueError(f"columns differ from table {name}: {wrong}")
    return df.select(*table.names)


# -- versions -----------------------------------------------------------------------------


def _write_version(df: DataFrame, name: str, layout: TableLayout) -> tuple[str, set[str]]:
    """Write ``df`` as a new version; returns its folder and its partition folders.

    The files are written through a short-lived external table, because that is
    how Spark writes bucketed files and reports the partitions it produced.
    """
    spark = df.sparkSession
    path = _new_version(spark, name)
    if layout == PLAIN:
        df.write.parquet(path)
        return path, set()
    loading = f"{name.rsplit('.', 1)[0]}.loading_{uuid.uuid4().hex}"
    writer = df.write.option("path", path)
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_columns)
    if layout.bucket_by:
        writer = writer.bucketBy(layout.buckets, *layout.bucket_by).sortBy(*layout.bucket_by)
    writer.saveAsTable(loading)
    try:
        return path, _partitions(spark, loading) if layout.partition_by else set()
    finally:
        spark.sql(f"DROP TABLE {loading}")  # external: the files stay


def _clustered(df: DataFrame, layout: TableLayout) -> DataFrame:
    """Arrange rows for a full write: few, evenly sized files per partition or bucket.

    The rebalance hint splits a partition value that holds much of the data, and
    coalesces small ones.
    """
    if layout.bucket_by:
        return df.repartition(layout.buckets, *layout.bucket_by)
    if layout.partition_by:
        return df.hint("rebalance", *layout.partition_columns)
    return df


def _partition_clause(folder: str) -> str:
    """``PARTITION (...)`` for a partition folder such as ``season=2025/round=3``."""

    def part(text: str) -> str:
        column, value = text.split("=", 1)
        if value == _NULL_PARTITION:
            return f"`{column}` = null"
        plain = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"`{column}` = '{plain}'"

    return f"PARTITION ({', '.join(map(part, folder.split('/')))})"


def _partitions(spark: SparkSession, name: str) -> set[str]:
    """Partition folders such as ``season=2025`` known to the catalog."""
    return {row[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def _point_partitions(spark: SparkSession, name: str, paths: dict[str, str]) -> None:
    """Point each partition at its folder, adding the ones the catalog does not know yet.

    The catalog is asked about these partitions only, however many the table has."""
    folders = sorted(paths)
    for first in range(0, len(folders), PARTITIONS_PER_CALL):
        some = folders[first : first + PARTITIONS_PER_CALL]
        added = " ".join(f"{_partition_clause(f)} LOCATION '{paths[f]}'" for f in some)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    for folder in folders:
        clause = _partition_clause(folder)
        spark.sql(f"ALTER TABLE {name} {clause} SET LOCATION '{paths[folder]}'")


def _publish(
    spark: SparkSession, name: str, path: str, partitions: set[str], partitioned: bool
) -> None:
    """Point the table, or the given partitions of it, at freshly written files."""
    if partitioned:
        _point_partitions(spark, name, {folder: f"{path}/{folder}" for folder in partitions})
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def _stored_layout(spark: SparkSession, name: str) -> TableLayout:
    """Layout of an existing table, from one catalog call."""
    rows = [(row[0], row[1]) for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect()]
    details = dict(rows)
    partition_by = None
    if ("# Partition Information", "") in rows:
        start = rows.index(("# Partition Information", "")) + 2  # skip the header line
        names = [text for text, _ in rows[start : rows.index(("", ""), start)]]
        partition_by = names[0] if len(names) == 1 else tuple(names)
    buckets = int(details.get("Num Buckets", 0))
    listed = details.get("Bucket Columns", "[]").strip("[]")
    bucket_by = tuple(part.strip().strip("`") for part in listed.split(",")) if buckets else ()
    return TableLayout(partition_by, bucket_by, buckets)


# -- writes -------------------------------------------------------------------------------


def overwrite(
    df: DataFrame, name: str, layout: TableLayout = PLAIN, *, partitions: int | None = None
) -> None:
    """Replace the whole table, creating it on first use (``layout`` applies then).

    ``partitions`` is how many partitions a large ``df`` reaches (see :func:`reached_if_large`): if
    they are few, its rows are not moved once more for the sake of few files.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists:
        df, layout = _same_columns(df, name), _stored_layout(spark, name)
    in_place = not layout.bucket_by and partitions is not None and partitions <= PARTITIONS_PER_LARGE_TASK
    path, written = _write_version(df if in_place else _clustered(df, layout), name, layout)
    if not exists:
        ensure_table(spark, name, df.schema, layout, location=path)
    _publish(spark, name, path, written, layout.partition_by is not None)
    if layout.partition_by:
        for folder in _partitions(spark, name) - written:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {_partition_clause(folder)}")


def append(df: DataFrame, name: str) -> None:
    """Add rows, creating the table on first use."""
    if df.sparkSession.catalog.tableExists(name):
        _same_columns(df, name).write.insertInto(name)
    else:
        overwrite(df, name)


def insert_values(spark: SparkSession, name: str, *rows: str) -> None:
    """Insert literal rows, each given as SQL text such as ``(1, current_timestamp())``."""
    spark.sql(f"INSERT INTO {name} VALUES {', '.join(rows)}")


def delete_all(spark: SparkSession, name: str) -> None:
    """Remove every row; the table and its layout stay."""
    overwrite(spark.table(name).limit(0), name)


def replace_partition(df: DataFrame, name: str, column: str, value: str) -> None:
    """Make ``df`` the whole content of the partition ``column = value``.

    Other partitions are untouched, and an empty ``df`` empties the partition, so
    a batch can be loaded again at any time.  No shuffle: all rows share the
    value, and the switch is one catalog change.
    """
    if not _PLAIN_VALUE.fullmatch(value):
        raise ValueError(f"not usable as a partition value: {value!r}")
    spark = df.sparkSession
    stamped = df.withColumn(column, F.lit(value))
    if not spark.catalog.tableExists(name):
        ensure_table(spark, name, stamped.schema, TableLayout(partition_by=column))
    rows = _same_columns(stamped, name).drop(column)
    path = _new_version(spark, name)
    rows.write.parquet(path)
    _point_partitions(spark, name, {f"{column}={value}": path})
    spark.catalog.refreshTable(name)


def _reached(target: DataFrame, columns: Sequence[str], rows: DataFrame) -> tuple[DataFrame, int]:
    """The partitions of ``target`` that ``rows`` reach, and their number.

    The values are those of single catalog partitions, each of which gets its own catalog update
    later, so they fit the driver; as literals they prune the scan.
    """
    found = [tuple(row) for row in rows.select(*columns).distinct().collect()]
    whole = [values for values in found if None not in values]
    tests = [F.lit(False)]
    if whole and len(columns) == 1:
        tests.append(F.col(columns[0]).isin([value for (value,) in whole]))
    elif whole:
        each = [F.col(c).isin(sorted({values[i] for values in whole})) for i, c in enumerate(columns)]
        pairs = F.struct(*columns).isin([F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, values)]) for values in whole])
        tests.append(reduce(and_, each) & pairs)
    for values in (values for values in found if None in values):
        tests.append(reduce(and_, [F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in zip(columns, values)]))
    return target.where(reduce(or_, tests)), len(found)


def _broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which Spark broadcasts a side of a join; -1 when it does not."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def is_large(rows: DataFrame) -> bool:
    """Whether ``rows``, by the size of the files Spark plans to read for them, are too many to broadcast."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > _broadcast_limit(rows.sparkSession)


def reached_if_large(rows: DataFrame, *columns: str) -> int | None:
    """How many partitions by ``columns`` the rows reach if they are many, else ``None``."""
    return rows.select(*columns).distinct().count() if is_large(rows) else None


def upsert(
    source: DataFrame,
    name: str,
    *,
    keys: Sequence[str],
    update: Sequence[str],
    guard: str | None = None,
    match: str | None = None,
    insert: bool = True,
    layout: TableLayout = PLAIN,
    unique_source: bool = False,
    small_source: bool | None = None,
    reaching: DataFrame | None = None,
    keys_checked: bool = False,
) -> None:
    """Merge ``source`` into the table (see :func:`merge_rows`), creating it on first use.

    In a partitioned table only the partitions the source reaches are read and rewritten.  The
    source is written down once, so that all uses see the same rows; the bytes of this copy decide
    the plan unless ``small_source`` does: what Spark would broadcast is broadcast.  Several source
    rows for one target row, and any repeated key under ``unique_source``, are found by the merge
    itself, which then writes nothing.

    A large source need not be written down: with ``small_source=False`` and ``reaching``, rows that
    tell which partitions it may reach, it is computed in the merge, whose join keeps the
    partitioning by key that the source may have, and neither is rearranged for writing if those
    partitions are few.  ``keys_checked`` promises that no key of the source is null.
    """
    spark = source.sparkSession
    if not spark.catalog.tableExists(name):
        if not insert:
            raise ValueError(f"no table {name} to update")
        direct = small_source is False and reaching is not None and layout.partition_by
        overwrite(
            source, name, layout,
            partitions=reaching.select(*layout.partition_columns).distinct().count() if direct else None,
        )
        return
    layout = _stored_layout(spark, name)
    strange = [column for column in layout.partition_columns if column not in keys]
    if strange:
        raise ValueError(f"{name} is partitioned by {strange[0]}, which is not a merge key")
    target = spark.table(name)

    def merge(
        rows: DataFrame, reached: DataFrame, small: bool, partitions: int = 0,
        in_place: int = PARTITIONS_PER_WRITING_TASK,
    ) -> tuple[str, set[str]]:
        merged = merge_rows(
            reached, rows, keys=keys, update=update, guard=guard, match=match, insert=insert, small_source=small,
            unique_source=unique_source, keys_checked=keys_checked, buckets=(layout.buckets, layout.bucket_by) if layout.bucket_by else None,
        )
        if not layout.bucket_by and partitions > in_place:
            merged = _clustered(merged, layout)
        try:
            return _write_version(merged, name, layout)
        except Exception as error:
            if any(reason in str(error) for reason in (AMBIGUOUS, REPEATED)):
                raise ValueError(f"{name}: {_reason(str(error))}") from error
            raise

    if small_source is False and not layout.partition_by:
        path, partitions = merge(source, target, False)  # one use of the source, nothing to find out
    elif small_source is False and reaching is not None:
        reached, number = _reached(target, layout.partition_columns, reaching)
        path, partitions = merge(source, reached, False, number, PARTITIONS_PER_LARGE_TASK)
    else:
        with staged_files(source, "upsert") as (rows, size):
            reached, number = _reached(target, layout.partition_columns, rows) if layout.partition_by else (target, 0)
            small = not layout.bucket_by and size <= _broadcast_limit(spark) if small_source is None else small_source
            path, partitions = merge(rows, reached, small, number)
    _publish(spark, name, path, partitions, layout.partition_by is not None)


def _reason(text: str) -> str:
    """The line of an error message that says which key is at fault."""
    return next(line for line in text.splitlines() if AMBIGUOUS in line or REPEATED in line)


# -- clean-up -----------------------------------------------------------------------------


def _live_folders(spark: SparkSession, name: str, layout: TableLayout) -> set[str]:
    """Last path part(s) of the folders the catalog points at."""

    def location(clause: str = "") -> str:
        rows = spark.sql(f"DESCRIBE EXTENDED {name} {clause}").collect()
        return next(row.data_type for row in rows if row.col_name == "Location").rstrip("/")

    if not layout.partition_by:
        return {location().rsplit("/", 1)[-1]}
    root = _root(spark, name).split(":", 1)[-1].lstrip("/")
    return {
        location(_partition_clause(folder)).split(root, 1)[-1].strip("/").split("/")[0]
        for folder in _partitions(spark, name)
    }


def prune_versions(spark: SparkSession, name: str, older_than_hours: float = 168.0) -> list[str]:
    """Delete version folders that no part of the table points at; returns their names.

    Keep the age above the longest running query, which may still read them.
    """
    layout = _stored_layout(spark, name)
    live = _live_folders(spark, name, layout)
    root, limit = _root(spark, name), (time.time() - older_than_hours * 3600) * 1000
    versions = list_folders(spark, root).items()
    dead = sorted(v for v, modified in versions if v not in live and modified <= limit)
    for version in dead:
        delete_folder(spark, f"{root}/{version}")
    return dead

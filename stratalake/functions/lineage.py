"""Lineage columns: where a row came from and when it was written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INGESTED_AT = "ingestion_timestamp"
SOURCE_FILE = "source_file"
BATCH_ID = "batch_id"
CREATED_AT = "created_timestamp"
UPDATED_AT = "updated_timestamp"

INGESTION_COLUMNS = (INGESTED_AT, SOURCE_FILE)
LINEAGE_COLUMNS = (*INGESTION_COLUMNS, BATCH_ID)
WRITE_TIME_COLUMNS = (CREATED_AT, UPDATED_AT)


def add_ingestion_metadata(scan: DataFrame) -> DataFrame:
    """Add load time and source file.  Call it on the file scan itself: the
    hidden ``_metadata`` column does not survive a projection."""
    return scan.withColumns(
        {INGESTED_AT: F.current_timestamp(), SOURCE_FILE: F.col("_metadata.file_path")}
    )


def stamp_batch(df: DataFrame, batch_id: str) -> DataFrame:
    return df.withColumn(BATCH_ID, F.lit(batch_id))


def stamp_write_times(df: DataFrame) -> DataFrame:
    """Created and updated time; Spark evaluates both once per query, so they are equal."""
    return df.withColumns(dict.fromkeys(WRITE_TIME_COLUMNS, F.current_timestamp()))

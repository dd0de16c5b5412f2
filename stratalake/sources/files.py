"""Strict readers: the schema is given, and a malformed record fails the job.

Two properties of Spark's readers matter to callers.  Failing is lazy, and it is
per column: a query that does not read a column does not notice a bad cell in
it.  Write all columns of a scan to a table before running pruned queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MALFORMED = "FAILFAST"


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, *, check_header: bool = True
) -> DataFrame:
    """CSV with a header line.

    Spark matches CSV columns by position; with ``check_header`` a header whose
    names differ from the schema is an error instead of silently shifted data.
    """
    return spark.read.csv(
        path, schema=schema, header=True, mode=MALFORMED, enforceSchema=not check_header
    )


def read_json(
    spark: SparkSession, path: str, schema: StructType | str, *, multi_line: bool = False
) -> DataFrame:
    """JSON lines from a file or a folder, nested structs kept.

    ``multi_line`` reads one document (object or array) per file instead; such a
    file cannot be split, so parallelism is the number of files.
    """
    return spark.read.json(path, schema=schema, mode=MALFORMED, multiLine=multi_line)

"""One row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep an arbitrary row per key.  Null keys form one group."""
    return df.dropDuplicates(list(keys))


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Keep the first row per key in ``order``; repeatable when the order is total.

    Because only rank 1 is kept, Spark already cuts every group to one row per
    map task before the shuffle (``WindowGroupLimit``), so a key that holds a
    large share of the input does not end up whole in one task.
    """
    position = "__position"
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(position, F.row_number().over(window))
        .where(F.col(position) == 1)
        .drop(position)
    )

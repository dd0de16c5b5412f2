"""Star-schema building blocks: dimension look-ups and facts made of several sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_sides(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    output: Mapping[str, str],
    how: str = "inner",
) -> DataFrame:
    """Equi-join and pick the output columns from named sides.

    ``on`` maps left to right key columns.  ``output`` maps each result column to
    ``"left.<column>"`` or ``"right.<column>"``.  Null keys never match.  There
    is no join hint: Spark broadcasts a side only when its size allows it.
    """
    left, right = left.alias("left"), right.alias("right")
    condition = [F.col(f"left.{a}") == F.col(f"right.{b}") for a, b in on.items()]
    return left.join(right, condition, how).select(
        *[F.col(source).alias(name) for name, source in output.items()]
    )


def union_labelled(
    parts: Mapping[str, DataFrame], label: str, drop: tuple[str, ...] = ()
) -> DataFrame:
    """Stack the parts by column name, duplicates kept, with a column naming the part."""
    stacked = [df.drop(*drop).withColumn(label, F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, stacked)

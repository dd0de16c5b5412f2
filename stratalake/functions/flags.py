"""Result indicators of a fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_result_flags(
    df: DataFrame, position: str = "final_position", points: str = "points"
) -> DataFrame:
    """Win, podium and scored flags; each is null where its input is null."""
    place = F.col(position)
    return df.withColumns(
        {
            "is_win": place == F.lit(1),
            "is_podium": place.between(1, 3),
            "has_points": F.col(points) > F.lit(0),
        }
    )

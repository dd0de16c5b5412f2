"""Season standings: totals per entity, ranked within the season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.sums import PARTS, exact_parts, exact_total
from stratalake.storage import written_copy

MEASURES = ("race_starts", "total_points", "number_of_wins", "number_of_podiums")


def season_totals(
    fact: DataFrame, dimension: DataFrame, key: str, labels: Sequence[str], season: str = "season"
) -> DataFrame:
    """Starts, points, wins and podiums per season and entity, with the entity's labels.

    The fact is summed per (season, key) before the join: a hot entity is folded
    inside each map task and only totals reach the join.  Summing again after the
    join keeps the meaning of "join, then group" for a dimension that repeats a key.  Points are
    added without rounding, so equal totals tie however the rows are spread.
    """
    counts = {
        "race_starts": F.count(F.lit(1)),
        "number_of_wins": F.count_if("is_win"),
        "number_of_podiums": F.count_if("is_podium"),
    }
    per_key = fact.groupBy(season, key).agg(
        *[count.alias(name) for name, count in counts.items()],
        *[F.expr(part).alias(f"points_{name}") for name, part in exact_parts("points").items()],
    )
    total = exact_total({name: f"sum(points_{name})" for name in PARTS})
    return (
        per_key.join(dimension.select(key, *labels), key)
        .groupBy(season, key, *labels)
        .agg(*[F.sum(name).alias(name) for name in counts], F.expr(total).alias("total_points"))
        .select(season, key, *labels, *MEASURES)
    )


def _best_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in columns]


def rank_spread(
    rows: DataFrame, group: Sequence[str], scores: Sequence[str], name: str, tasks: int | None = None
) -> DataFrame:
    """``RANK()`` over ``group`` by descending ``scores`` without one task per group.

    Equal scores share a rank, so only distinct scores have to be ordered.  They
    are range-partitioned over all groups; the rank of a score is one plus the
    rows in earlier slices of its group plus the rows before it in its own slice.
    The slices are written down first, because a slice number must not change
    between the two places that use it.
    """
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written_copy(rows, "ranking")
    sliced = written_copy(
        rows.groupBy(*group, *scores)
        .agg(F.count(F.lit(1)).alias("__n"))
        .repartitionByRange(tasks, *group, *_best_first(scores))
        .withColumn("__slice", F.spark_partition_id()),
        "slices",
    )
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    per_group = before.partitionBy(*group).orderBy("__slice")
    per_slice = before.partitionBy(*group, "__slice").orderBy(*_best_first(scores))

    def total_before(window) -> Column:
        return F.coalesce(F.sum("__n").over(window), F.lit(0))

    earlier_slices = (
        sliced.groupBy(*group, "__slice")
        .agg(F.sum("__n").alias("__n"))
        .select(*group, "__slice", total_before(per_group).alias("__earlier"))
    )
    ranked = _match(sliced, earlier_slices, [*group, "__slice"]).select(
        *group,
        *scores,
        (F.lit(1) + F.col("__earlier") + total_before(per_slice)).cast("int").alias(name),
    )
    return _match(rows, ranked, [*group, *scores])


def _match(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inner join on equal-or-both-null columns, each kept once."""
    left, right = left.alias("l"), right.alias("r")
    condition = [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in columns]
    extra = [F.col(f"r.{name}") for name in right.columns if name not in columns]
    return left.join(right, condition).select("l.*", *extra)


def standings(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    labels: Sequence[str],
    season: str = "season",
    spread: bool = False,
) -> DataFrame:
    """Rank entities within each season by points, then wins; ties share a rank.

    A season is ranked in one sorted, spilling window of at most one row per dimension row.
    ``spread`` ranks it over many tasks instead (:func:`rank_spread`), with the same result;
    the plan is the caller's choice and never changes with the data.
    """
    totals = season_totals(fact, dimension, key, labels, season)
    scores = ["total_points", "number_of_wins"]
    if not spread:
        window = Window.partitionBy(season).orderBy(*_best_first(scores))
        ranked = totals.withColumn("standing", F.rank().over(window))
    else:
        ranked = rank_spread(totals, [season], scores, "standing")
    return ranked.select(season, key, *labels, "standing", *MEASURES)

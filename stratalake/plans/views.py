"""The two analytical views over gold."""

from __future__ import annotations

from stratalake.functions.sums import PARTS, exact_parts, exact_total
from stratalake.plans.lake import Lake
from stratalake.sinks.tables import create_view


def standings_sql(fact: str, dimension: str, entity: str) -> str:
    """Season standings of one entity (``driver`` or ``constructor``) as a query.

    Points are summed per id before the dimension is joined, so the join sees one
    row per season and id instead of every result.  They are added without rounding, so
    equal totals tie.
    """
    identity, name = f"{entity}_id", f"{entity}_name"
    parts = ", ".join(f"{part} AS points_{n}" for n, part in exact_parts("points").items())
    total = exact_total({n: f"sum(per_id.points_{n})" for n in PARTS})
    return f"""
        SELECT season, {identity}, {name}, nationality,
               rank() OVER best_first AS standing,
               race_starts, total_points, number_of_wins, number_of_podiums
        FROM (
            SELECT per_id.season, named.{identity}, named.{name}, named.nationality,
                   sum(per_id.starts) AS race_starts,
                   {total} AS total_points,
                   sum(per_id.wins) AS number_of_wins,
                   sum(per_id.podiums) AS number_of_podiums
            FROM (
                SELECT season, {identity}, count(*) AS starts, {parts},
                       count_if(is_win) AS wins, count_if(is_podium) AS podiums
                FROM {fact}
                GROUP BY season, {identity}
            ) AS per_id
            INNER JOIN {dimension} AS named USING ({identity})
            GROUP BY ALL
        ) AS totals
        WINDOW best_first AS (PARTITION BY season ORDER BY total_points DESC, number_of_wins DESC)
    """


def build_views(lake: Lake) -> None:
    """Create or replace both views.  They read gold when queried, at any size of the data."""
    fact = lake.name("gold", "fact_session_results")
    for entity in ("driver", "constructor"):
        query = standings_sql(fact, lake.name("gold", f"dim_{entity}s"), entity)
        create_view(lake.spark, lake.name("gold", f"v_{entity}_standing"), query)

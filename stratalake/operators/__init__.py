"""DataFrame-to-DataFrame operators."""

from stratalake.operators.conform import ConformSpec, conform
from stratalake.operators.dedupe import any_per_key, first_per_key
from stratalake.operators.merge import merge_rows
from stratalake.operators.quality import RowLoss, removed_rows
from stratalake.operators.standings import rank_spread, season_totals, standings
from stratalake.operators.star import join_sides, union_labelled

__all__ = [
    "ConformSpec",
    "RowLoss",
    "any_per_key",
    "conform",
    "first_per_key",
    "join_sides",
    "merge_rows",
    "rank_spread",
    "removed_rows",
    "season_totals",
    "standings",
    "union_labelled",
]

"""Text clean-up on built-in expressions only, so it stays inside code generation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def title_case(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Capitalise each space-separated word and lower-case the rest, in place.

    Only a space starts a word: ``argentine-italian`` becomes ``Argentine-italian``.
    """
    return df.withColumns({name: F.initcap(F.col(name)) for name in columns})


def full_name(*parts: str) -> Column:
    """Title-cased parts joined by a space; null parts are skipped, all null gives ``''``."""
    return F.initcap(F.concat_ws(" ", *[F.col(part) for part in parts]))

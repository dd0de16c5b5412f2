"""Sums of doubles that do not depend on the order of the rows.

Adding doubles rounds at every step, so a total depends on how rows are partitioned, and equal
totals may come out unequal.  Here every value is split into whole numbers, which add without
rounding: its floor and two pieces of 30 bits of its fraction.  The three sums are put together
once, at the end.  Parts of sums may be added again before that, for example after a join.

Everything is SQL text, for views as well as for DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping

PARTS = ("whole", "high", "low", "other")
_LARGEST = "4503599627370496D"  # 2**52: below it a double has its fraction, and whole sums fit
_UNIT = 1 << 30


def exact_parts(value: str) -> dict[str, str]:
    """Aggregates by part name.  ``other`` adds values of 2**52 or more, infinities and NaN as
    they are; it is null without such values, as all parts are without any value."""
    x = f"cast({value} AS DOUBLE)"
    fits, fraction = f"abs({x}) < {_LARGEST}", f"({x} - floor({x}))"
    high = f"floor({fraction} * {_UNIT}D)"
    return {
        "whole": f"sum(CASE WHEN {fits} THEN floor({x}) END)",
        "high": f"sum(CASE WHEN {fits} THEN {high} END)",
        "low": f"sum(CASE WHEN {fits} THEN floor(({fraction} * {_UNIT}D - {high}) * {_UNIT}D) END)",
        "other": f"sum(CASE WHEN NOT ({fits}) THEN {x} END)",
    }


def exact_total(parts: Mapping[str, str]) -> str:
    """The double nearest to the sum, from SQL texts of the four parts (columns or sums of them)."""
    high = f"({parts['high']} + shiftright({parts['low']}, 30))"
    whole = f"({parts['whole']} + shiftright({high}, 30))"
    fraction = f"(({high} & {_UNIT - 1}L) * {_UNIT}L + ({parts['low']} & {_UNIT - 1}L))"
    total = f"(cast({whole} AS DOUBLE) + {fraction} / {float(_UNIT * _UNIT):.0f}D)"
    return f"CASE WHEN {parts['other']} IS NULL THEN {total} ELSE {parts['other']} + coalesce({total}, 0D) END"

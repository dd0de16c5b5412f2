"""Row-loss audit of a cleaning step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratalake.operators.conform import keys_present


def removed_rows(
    df: DataFrame, keys: Sequence[str], checked: Sequence[str] | None = None, by: str | None = None
) -> DataFrame:
    """One row, or one for each value of ``by``: how many rows the null-key check and the
    de-duplication remove.

    ``checked`` are the columns the null check looks at, by default all ``keys``; where it looks at
    fewer, rows with another null key form groups of their own, as in the de-duplication.

    Both counts come out of one scan.  Rows are counted per key before the
    shuffle, so a hot key travels as a single counter.
    """
    valid = keys_present(keys if checked is None else checked)
    parts = [by] if by else []
    per_key = df.groupBy(*parts, *keys).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    counts = per_key.groupBy(*parts).agg(
        F.coalesce(F.sum("n"), zero).alias("rows_in"),
        F.coalesce(F.sum(F.when(~valid, F.col("n"))), zero).alias("invalid_rows"),
        F.count(F.when(valid, 1)).alias("rows_out"),
    )
    removed = F.col("rows_in") - F.col("rows_out")
    return counts.select(
        *parts,
        "rows_in",
        "invalid_rows",
        (removed - F.col("invalid_rows")).alias("duplicate_rows"),
        removed.alias("removed_rows"),
        "rows_out",
    )


class RowLoss:
    """Counts the rows of a cleaning step while its result is computed, without a job of its own.

    The step passes its input through :meth:`entering` and its output through :meth:`leaving`.
    Once one action has computed the output, :meth:`counts` has the numbers, one set for each
    label of ``parts`` (conditions on rows; by default all rows under ``None``).

    Where Spark finds out on the way that nothing is left, it cuts the rest of the plan off and may
    lose the numbers of the input with it; then, and only then, the input is counted by a job.
    """

    def __init__(self, parts: dict[str | None, Column] | None = None):
        self.parts = parts or {None: F.lit(True)}
        self._before, self._after = Observation(), Observation()

    def entering(self, df: DataFrame, checked: Sequence[str]) -> DataFrame:
        """All rows, and those a null among the checked columns removes."""
        bad = ~keys_present(checked)
        counts = []
        for i, part in enumerate(self.parts.values()):
            counts += [F.count_if(part).alias(f"rows_{i}"), F.count_if(part & bad).alias(f"bad_{i}")]
        self._recount = lambda: df.agg(*counts).first().asDict()
        return df.observe(self._before, *counts)

    def leaving(self, df: DataFrame) -> DataFrame:
        counts = [F.count_if(part).alias(f"rows_{i}") for i, part in enumerate(self.parts.values())]
        return df.observe(self._after, *counts)

    def counts(self) -> dict[str | None, dict[str, int]]:
        """Per label the columns of :func:`removed_rows`."""
        before, after = _observed(self._before), _observed(self._after)
        if before is None:
            before = self._recount()
        found = {}
        for i, label in enumerate(self.parts):
            rows, bad = before[f"rows_{i}"], before[f"bad_{i}"]
            out = after[f"rows_{i}"] if after else 0  # the output is left out only if it is empty
            found[label] = {
                "rows_in": rows,
                "invalid_rows": bad,
                "duplicate_rows": rows - bad - out,
                "removed_rows": rows - out,
                "rows_out": out,
            }
        return found


def _observed(observation: Observation) -> dict[str, int] | None:
    """The metrics, or ``None`` when the step was not part of the plan that ran in the end."""
    return observation.get if observation._jo.getRow().length() else None

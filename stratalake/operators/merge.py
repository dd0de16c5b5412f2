"""The row logic of an upsert, as a pure DataFrame operator.

Conditions are SQL text over the aliases ``t`` (target) and ``s`` (source).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.conform import keys_present

IN_TARGET, IN_SOURCE = "__in_target", "__in_source"
TARGET_ROW, SOURCE_ROW, TIMES = "__target_row", "__source_row", "__times"
AMBIGUOUS = "several source rows match one target row"
REPEATED = "the source was said to be unique, but repeats a key"


def _failing(bad: Column, message: str, keys: Sequence[str], otherwise: Column) -> Column:
    """``otherwise``, or an error that names the key where ``bad``."""
    shown = F.to_json(F.struct(*[F.col(f"s.{key}").alias(key) for key in keys]))
    return F.when(bad, F.raise_error(F.concat(F.lit(f"{message}: "), shown))).otherwise(otherwise)


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    *,
    keys: Sequence[str],
    update: Sequence[str],
    guard: str | None = None,
    match: str | None = None,
    insert: bool = True,
    small_source: bool = False,
    unique_source: bool = False,
    keys_checked: bool = False,
    buckets: tuple[int, Sequence[str]] | None = None,
) -> DataFrame:
    """All rows of ``target`` after merging ``source``.

    A target row matched on ``keys`` (and ``match``) takes the ``update`` columns from the source
    when ``guard`` is true; a null guard counts as false.  Other target rows stay.  Unmatched source
    rows are added when ``insert``.

    A null key never matches: rows with one, of either side, go round the join, so they are neither
    shuffled nor gathered in one task, and a bucketed target keeps its layout.  With ``keys_checked``
    the source is known to have none, and is computed once.

    Several source rows for one target row are an error, raised while the rows are computed: source
    rows are counted per key, or per target row if there is a ``match``, in the partitioning that
    the join needs anyway.  With ``unique_source`` any repeated source key is an error.

    A full outer join can never be broadcast, so with ``small_source`` (for sources of a checked
    size, given as files) the source is broadcast: a left join that reads the target in place, plus
    the source rows without a match.  Both plans give the same rows.  ``buckets`` says how a target
    is bucketed, so that only the source is arranged.
    """
    missing = sorted({*keys, *update} - set(source.columns))
    if missing:
        raise ValueError(f"merge source lacks columns {missing}")
    can_match = keys_present(keys)
    loose = [target.where(~can_match)]
    if insert and not keys_checked:
        loose.append(source.where(~can_match).select(*target.columns))

    t = target.where(can_match).withColumn(IN_TARGET, F.lit(True))
    s = source.where(can_match).withColumn(IN_SOURCE, F.lit(True))
    if small_source:
        s = s.withColumn(SOURCE_ROW, F.monotonically_increasing_id())  # the same in every scan of files
    elif buckets:
        s = s.repartition(buckets[0], *buckets[1])
    counted = s.withColumn(TIMES, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    if match:
        t = t.withColumn(TARGET_ROW, F.monotonically_increasing_id())
    t, s = t.alias("t"), (F.broadcast(counted) if small_source else counted).alias("s")
    on = reduce(and_, [F.col(f"t.{key}") == F.col(f"s.{key}") for key in keys])
    if match:
        on = on & F.expr(match)

    joined = t.join(s, on, "full_outer" if insert and not small_source else "left")
    met = F.col(f"t.{IN_TARGET}").isNotNull() & F.col(f"s.{IN_SOURCE}").isNotNull()
    applies = met & F.coalesce(F.expr(guard), F.lit(False)) if guard else met
    columns = {
        name: F.when(applies, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))
        if name in update
        else F.col(f"t.{name}")
        for name in target.columns
    }
    if insert and not small_source:
        columns = {
            name: F.when(F.col(f"t.{IN_TARGET}").isNotNull(), value).otherwise(F.col(f"s.{name}"))
            for name, value in columns.items()
        }
    first = target.columns[0]  # the checks ride on a column, so that they are made where rows are
    repeated = F.col(f"s.{TIMES}") > 1
    if unique_source:
        columns[first] = _failing(repeated, REPEATED, keys, columns[first])
    elif not match:
        columns[first] = _failing(met & repeated, AMBIGUOUS, keys, columns[first])
    elif not small_source:
        # Only target rows with a repeated key can meet two source rows; they are counted one by one.
        per_row = Window.partitionBy(*[F.col(f"t.{key}") for key in keys], F.col(f"t.{TARGET_ROW}"))
        twice = F.count(F.when(met, 1)).over(per_row) > 1
        columns[first] = _failing(met & repeated & twice, AMBIGUOUS, keys, columns[first])
    else:
        # The same without moving the target: pairs of repeated keys in a branch that adds no rows.
        pairs = t.join(s, on).where(repeated).groupBy(f"t.{TARGET_ROW}")
        twice = pairs.agg(F.count(F.lit(1)).alias("n"), *[F.first(f"s.{key}").alias(key) for key in keys])
        failed = _failing(F.lit(True), AMBIGUOUS, keys, F.lit(None)).cast(target.schema[0].dataType)
        nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in target.schema[1:]]
        loose.append(twice.where("n > 1").alias("s").select(failed.alias(first), *nulls))
    merged = joined.select(*[value.alias(name) for name, value in columns.items()])

    if insert and small_source:
        found = t.join(s, on).select(f"s.{SOURCE_ROW}").distinct()
        new = counted.join(F.broadcast(found), SOURCE_ROW, "left_anti").select(*target.columns, TIMES).alias("s")
        if unique_source:
            new = new.withColumn(first, _failing(F.col(TIMES) > 1, REPEATED, keys, F.col(first)))
        loose.append(new.select(*target.columns))
    return reduce(DataFrame.unionByName, loose, merged)

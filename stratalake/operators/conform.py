"""Cleaning of one dataset, described by data instead of by a script per dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.lineage import LINEAGE_COLUMNS, SOURCE_FILE
from stratalake.functions.text import full_name, title_case
from stratalake.operators.dedupe import any_per_key, first_per_key

if TYPE_CHECKING:
    from stratalake.operators.quality import RowLoss


@dataclass(frozen=True)
class ConformSpec:
    """How to clean one dataset.

    ``columns`` are the source columns to keep (all when empty) and ``drop`` the
    ones to leave out; ``renames`` maps source to target names.  Everything below
    uses target names: ``keys`` identify a row, ``names`` builds a full name from
    text columns or struct fields and drops the struct, ``title`` lists columns
    to title-case.  ``checked_keys`` are the key columns that are null-checked
    when the strict check of all keys is switched off.
    """

    keys: tuple[str, ...]
    columns: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    renames: Mapping[str, str] = field(default_factory=dict)
    names: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    title: tuple[str, ...] = ()
    checked_keys: tuple[str, ...] = ()


def keys_present(keys: Sequence[str]) -> Column:
    """True where no key column is null."""
    return reduce(and_, [F.col(key).isNotNull() for key in keys], F.lit(True))


def rename(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename in bulk; unlike ``withColumnsRenamed`` an unknown column is an error."""
    unknown = sorted(set(renames) - set(df.columns))
    if unknown:
        raise ValueError(f"cannot rename missing columns {unknown}; have {df.columns}")
    return df.withColumnsRenamed(dict(renames))


def shape(df: DataFrame, spec: ConformSpec) -> DataFrame:
    """Project, rename and flatten; row count unchanged."""
    if spec.columns:
        lineage = [name for name in LINEAGE_COLUMNS if name in df.columns]
        df = df.select(*spec.columns, *lineage)
    df = rename(df.drop(*spec.drop), spec.renames)
    for target, parts in spec.names.items():
        structs = {part.split(".")[0] for part in parts if "." in part}
        df = df.withColumn(target, full_name(*parts)).drop(*structs)
    return df


def business_order(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """A repeatable order for duplicates: every business column, then the source file."""
    ignored = {*keys, *LINEAGE_COLUMNS}
    order = [name for name in df.columns if name not in ignored]
    return [*order, SOURCE_FILE] if SOURCE_FILE in df.columns else order


def conform(
    df: DataFrame,
    spec: ConformSpec,
    *,
    strict_keys: bool = True,
    order: Sequence[str | Column] | None = None,
    arbitrary: bool = False,
    audit: RowLoss | None = None,
) -> DataFrame:
    """Apply ``spec``: shape, reject null keys, one row per key, title-case.

    ``strict_keys=False`` only checks ``spec.checked_keys``.  ``arbitrary=True``
    keeps any duplicate; otherwise the survivor is the first in ``order``
    (default :func:`business_order`).  ``audit`` counts what is removed.
    """
    df = shape(df, spec)
    checked = spec.keys if strict_keys else spec.checked_keys
    if audit:
        df = audit.entering(df, checked)
    df = df.where(keys_present(checked))
    if arbitrary:
        df = any_per_key(df, spec.keys)
    else:
        df = first_per_key(df, spec.keys, order or business_order(df, spec.keys))
    if audit:
        df = audit.leaving(df)
    return title_case(df, spec.title)

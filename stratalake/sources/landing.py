"""Landing folders: one subfolder per batch, named by the batch id."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import SparkSession

from stratalake.storage import list_folders

_BATCH_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")
# Folders taken for batches: names that begin with a digit, as dates and numbers do.
BATCH_FOLDER = r"[0-9].*"


def valid_batch_id(batch_id: str | None) -> str:
    """The id itself, or an error when it is missing or not a plain folder name."""
    if not batch_id:
        raise ValueError("batch_id is missing")
    if not _BATCH_ID.fullmatch(batch_id):
        raise ValueError(f"not a batch id: {batch_id!r}")
    return batch_id


def batch_path(landing: str, batch_id: str | None, item: str) -> str:
    """Path of a file or folder of one batch."""
    return f"{landing.rstrip('/')}/{valid_batch_id(batch_id)}/{item}"


def landing_batches(spark: SparkSession, landing: str, pattern: str = BATCH_FOLDER) -> list[str]:
    """Names of the folders under ``landing`` that ``pattern`` takes for batches, in no order."""
    valid = re.compile(pattern)
    return [name for name in list_folders(spark, landing) if valid.fullmatch(name) and _BATCH_ID.fullmatch(name)]


def in_time_order(batch_ids: Iterable[str]) -> list[str]:
    """Batch ids, oldest first.

    They are ordered as text, which is only their order in time while all have the same length, so
    an id of another length than most is an error.  Ask for the order of what is still to be loaded
    only: finished batches may be named in any way.
    """
    found = sorted(batch_ids)
    lengths = Counter(map(len, found))
    if len(lengths) > 1:
        usual = lengths.most_common(1)[0][0]
        strays = [name for name in found if len(name) != usual]
        raise ValueError(f"batch ids differ in length and cannot be ordered: {strays} among {found}")
    return found

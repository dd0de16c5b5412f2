"""One starter per batch: a marker that only one driver can create.

The marker is a file in the control schema's folder.  On a distributed file system, ``create``
without overwriting is atomic; on a local one the operating system's exclusive create is used.
A marker holds who made it; it goes when the load ends, well or not.  A driver that was killed
leaves it behind, and whoever repeats the batch has to say so (``take_over``).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator
from contextlib import ExitStack, contextmanager
from pathlib import Path
from urllib.parse import unquote, urlparse

from stratalake.plans.lake import Lake
from stratalake.sources.landing import valid_batch_id
from stratalake.storage import create_new_file, delete_folder, read_text


class BatchClaimed(RuntimeError):
    """Another driver or thread is loading the batch."""


def _marker(lake: Lake, batch_id: str) -> str:
    folder = lake.spark.catalog.getDatabase(lake.schema("control")).locationUri.rstrip("/")
    return f"{folder}/_claims/{valid_batch_id(batch_id)}"


def _local(path: str) -> Path | None:
    parsed = urlparse(path)
    return Path(unquote(parsed.path)) if parsed.scheme in ("", "file") else None


def _create(lake: Lake, marker: str, owner: str) -> bool:
    """Make the marker unless it exists."""
    local = _local(marker)
    if local is None:
        return create_new_file(lake.spark, marker, owner)
    local.parent.mkdir(parents=True, exist_ok=True)
    try:
        file = os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
    except FileExistsError:
        return False
    with os.fdopen(file, "w") as out:
        out.write(owner)
    return True


@contextmanager
def claimed(lake: Lake, batch_id: str | None, *, take_over: bool = False) -> Iterator[None]:
    """Hold the claim on a batch inside the ``with`` block, or raise :class:`BatchClaimed`."""
    marker = _marker(lake, valid_batch_id(batch_id))
    owner = f"{lake.spark.sparkContext.applicationId} {uuid.uuid4().hex}"
    if take_over:
        delete_folder(lake.spark, marker)
    if not _create(lake, marker, owner):
        raise BatchClaimed(f"batch {batch_id} is being loaded by {read_text(lake.spark, marker) or 'another driver'}")
    try:
        yield
    finally:
        # Whoever took the claim over owns the marker now.
        if read_text(lake.spark, marker) == owner:
            delete_folder(lake.spark, marker)


@contextmanager
def all_claimed(lake: Lake, batch_ids: Iterable[str], *, take_over: bool = False) -> Iterator[None]:
    """Hold the claims on several batches; none is held if one is taken."""
    with ExitStack() as claims:
        for batch_id in batch_ids:
            claims.enter_context(claimed(lake, batch_id, take_over=take_over))
        yield

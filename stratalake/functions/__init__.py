"""Column-level helpers: lineage stamps, text clean-up and result flags."""

from stratalake.functions.flags import add_result_flags
from stratalake.functions.lineage import add_ingestion_metadata, stamp_batch, stamp_write_times
from stratalake.functions.text import full_name, title_case

__all__ = [
    "add_ingestion_metadata",
    "add_result_flags",
    "full_name",
    "stamp_batch",
    "stamp_write_times",
    "title_case",
]

"""Reading landing files and finding landing batches."""

from stratalake.sources.files import read_csv, read_json
from stratalake.sources.landing import batch_path, in_time_order, landing_batches, valid_batch_id

__all__ = ["batch_path", "in_time_order", "landing_batches", "read_csv", "read_json", "valid_batch_id"]

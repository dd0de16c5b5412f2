"""Writing tables: overwrite, append, partition replace, upsert, views."""

from stratalake.sinks.tables import (
    TableLayout,
    append,
    create_view,
    delete_all,
    ensure_schema,
    ensure_table,
    insert_values,
    overwrite,
    prune_versions,
    replace_partition,
    upsert,
)

__all__ = [
    "TableLayout",
    "append",
    "create_view",
    "delete_all",
    "ensure_schema",
    "ensure_table",
    "insert_values",
    "overwrite",
    "prune_versions",
    "replace_partition",
    "upsert",
]

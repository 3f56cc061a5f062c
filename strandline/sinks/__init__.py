"""Writers for catalog tables and datasets."""

from strandline.sinks.proof import differences, differing_ranges
from strandline.sinks.tables import (
    WHOLE_TIMES,
    UnknownColumns,
    append_audit_row,
    append_null_rows,
    append_rows,
    copy_dataset,
    create_table,
    drop_table,
    insert_values,
    replace_table,
    reset_database,
    with_load_time,
)

__all__ = [
    "WHOLE_TIMES",
    "UnknownColumns",
    "append_audit_row",
    "append_null_rows",
    "append_rows",
    "copy_dataset",
    "create_table",
    "differences",
    "differing_ranges",
    "drop_table",
    "insert_values",
    "replace_table",
    "reset_database",
    "with_load_time",
]

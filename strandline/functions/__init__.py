"""Column expressions. All of them are compositions of Spark built-ins."""

from strandline.functions.columns import (
    Total,
    apply_hints,
    cents,
    clean_identifier,
    day_of,
    epoch_to_timestamp,
    local_part,
    next_file_number,
    two_digits,
    user_identifier,
    wide_sum,
)

__all__ = [
    "Total",
    "apply_hints",
    "cents",
    "clean_identifier",
    "day_of",
    "epoch_to_timestamp",
    "local_part",
    "next_file_number",
    "two_digits",
    "user_identifier",
    "wide_sum",
]

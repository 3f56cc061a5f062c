"""Readers: files, catalog tables, inline rows and external databases."""

from strandline.sources.files import (
    count_rows,
    hinted_schema,
    read_by_path,
    read_csv,
    read_delimited,
    read_fixed_width,
    read_hinted,
)
from strandline.sources.jdbc import read_jdbc, write_jdbc
from strandline.sources.tables import csv_table, describe_table, external_table, inline_rows

__all__ = [
    "count_rows",
    "csv_table",
    "describe_table",
    "external_table",
    "hinted_schema",
    "inline_rows",
    "read_by_path",
    "read_csv",
    "read_delimited",
    "read_fixed_width",
    "read_hinted",
    "read_jdbc",
    "write_jdbc",
]

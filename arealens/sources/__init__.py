"""Readers for the raw layouts, stored tables and the Parquet sinks."""

from .geojson import explode_features, read_features
from .raw import (
    read_sdmx_csv,
    read_sheet,
    read_sheets,
    read_wide_tsv,
    with_source_order,
)
from .stored import Versions, choose_by_coverage, load_or_build, read_table, write_table

__all__ = [
    "choose_by_coverage",
    "explode_features",
    "load_or_build",
    "read_features",
    "read_sdmx_csv",
    "read_sheet",
    "read_sheets",
    "read_table",
    "Versions",
    "read_wide_tsv",
    "with_source_order",
    "write_table",
]

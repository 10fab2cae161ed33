"""Reusable DataFrame steps."""

from .filters import between_years, drop_null_codes, only_level, slice_rows, standard_stratum
from .keys import dense_ids, first_value, keep_first
from .ranking import first_per_group, preview, top_and_bottom, top_n
from .reshape import (
    columns_like,
    conditional_columns,
    rows_from_columns,
    split_dimensions,
    unpivot_years,
    year_columns,
)
from .sets import membership, overlap_summary

__all__ = [
    "between_years",
    "columns_like",
    "conditional_columns",
    "dense_ids",
    "drop_null_codes",
    "first_per_group",
    "first_value",
    "keep_first",
    "membership",
    "only_level",
    "overlap_summary",
    "preview",
    "rows_from_columns",
    "slice_rows",
    "split_dimensions",
    "standard_stratum",
    "top_and_bottom",
    "top_n",
    "unpivot_years",
    "year_columns",
]

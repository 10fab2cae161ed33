"""Column expressions. All are native Spark expressions; there is no Python UDF in the package."""

from .codes import (
    decade,
    icd10_is_respiratory,
    is_leap_year,
    level_name,
    parse_measure,
    region_level,
    region_code,
    title_label,
)
from .gases import gas_info
from .icd10 import icd10_category, icd10_description, icd10_name
from .measures import (
    as_exact,
    exact_avg,
    exact_sum,
    pearson,
    percentage,
    per_100k,
    per_capita_tonnes,
    round_half_even,
    safe_divide,
)

__all__ = [
    "as_exact",
    "decade",
    "exact_avg",
    "exact_sum",
    "gas_info",
    "icd10_category",
    "icd10_description",
    "icd10_is_respiratory",
    "icd10_name",
    "is_leap_year",
    "level_name",
    "parse_measure",
    "pearson",
    "per_100k",
    "per_capita_tonnes",
    "percentage",
    "region_code",
    "region_level",
    "round_half_even",
    "safe_divide",
    "title_label",
]

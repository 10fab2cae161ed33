"""Row filters. All are plain predicates, so Catalyst pushes them towards the scans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import strip

# The annual totals of a source, by raw and by tidy column name.
POPULATION_STRATUM = {"freq": "A", "unit": "NR", "sex": "T", "age": "TOTAL"}
HEALTH_STRATUM = {"frequency": "A", "sex": "T", "age_group": "TOTAL"}


def standard_stratum(
    df: DataFrame, stratum: Mapping[str, str], codes: Iterable[str] | None = None
) -> DataFrame:
    """Keep one stratum; columns the table does not have are not tested."""
    for column, value in stratum.items():
        if column in df.columns:
            df = df.filter(F.col(column) == value)
    if codes is not None:
        df = df.filter(F.col("icd10_group").isin(*codes))
    return df


def only_level(df: DataFrame, level: int | None, code_column: str = "nuts_id") -> DataFrame:
    """Keep one regional level; ``None`` keeps all.

    Tests the code length itself, which is a shorter predicate to push down than the level.
    """
    if level is None:
        return df
    size = F.length(strip(F.col(code_column)))
    sizes = {0: 2, 1: 3, 2: 4}
    return df.filter(size == sizes[level] if level in sizes else ~size.isin(*sizes.values()))


def drop_null_codes(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def between_years(df: DataFrame, first: int | None, last: int | None, column: str = "year") -> DataFrame:
    if first is not None:
        df = df.filter(F.col(column) >= first)
    if last is not None:
        df = df.filter(F.col(column) <= last)
    return df


def slice_rows(df: DataFrame, years: tuple[int, int] | None = None, **allowed) -> DataFrame:
    """Report slicer: an inclusive year range plus ``column=value`` or ``column=[values]``.

    An empty or missing selection does not filter.
    """
    if years is not None:
        df = between_years(df, *years)
    for column, wanted in allowed.items():
        if wanted is None:
            continue
        values = [wanted] if isinstance(wanted, (str, int, float)) else list(wanted)
        if values:
            df = df.filter(F.col(column).isin(*values))
    return df

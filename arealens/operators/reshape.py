"""Wide to long and long to wide."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns_like(df: DataFrame, prefix: str = "", suffix: str = "") -> list[str]:
    """Column names with the given prefix and suffix, in table order."""
    return [c for c in df.columns if c.startswith(prefix) and c.endswith(suffix)]


def year_columns(columns: Sequence[str], pattern: str = r"\s*(\d{4})\s*") -> dict[str, int]:
    """Headers that match the pattern as a whole -> their year.

    ``\\s*(\\d{4})\\s*`` takes plain years with blanks, ``Y_(\\d{4})`` and ``(\\d{4})_value`` the
    other layouts.
    """
    found = {c: re.fullmatch(pattern, c) for c in columns}
    return {c: int(m.group(1)) for c, m in found.items() if m}


def split_dimensions(df: DataFrame, composite: str, names: Sequence[str]) -> DataFrame:
    """Replace a comma-joined column by one column per name; missing parts become NULL."""
    parts = F.split(F.col(f"`{composite}`"), ",", len(names))
    rest = [F.col(f"`{c}`") for c in df.columns if c != composite]
    return df.select(*[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(names)], *rest)


def unpivot_years(df: DataFrame, ids: Sequence[str], years: Mapping[str, int], value: str) -> DataFrame:
    """One row per table row and year column. A narrow expansion: no shuffle."""
    if not years:
        raise ValueError("the table has no year columns")
    named = df.select(
        *[F.col(f"`{c}`") for c in ids],
        *[F.col(f"`{c}`").alias(str(year)) for c, year in years.items()],
    )
    long = named.unpivot(list(ids), [str(y) for y in years.values()], "year", value)
    return long.withColumn("year", F.col("year").cast("int"))


def rows_from_columns(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per table row and listed column, keeping the column name."""
    return df.unpivot(list(ids), list(columns), name, value)


def conditional_columns(key: str, names: Mapping[str, str], aggregate, value: str) -> list[Column]:
    """Aggregates that spread the rows of each key value to a named column.

    With the key values known, this is a pivot inside one aggregation: a single shuffle, a fixed
    schema, and no job to look up the values.
    """
    return [
        aggregate(F.when(F.col(key) == code, F.col(value))).alias(name) for code, name in names.items()
    ]

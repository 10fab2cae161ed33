"""Region codes, years and lenient number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters stripped from both ends of a code or a cell.
BLANKS = " \t\n\r\f\v\u00a0"

# A plain decimal number. Guards the cast: Spark's own cast also takes Java suffixes such as "12d".
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

MISSING = ":"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def region_code(text: Column) -> Column:
    """Region and country codes compare without surrounding blanks and in upper case."""
    return F.upper(strip(text))


def parse_measure(text: Column) -> Column:
    """Cell text to double; the missing mark and flagged cells such as ``12.3 b`` become NULL.

    Numbers beyond the range of a double are NULL as well.
    """
    cell = strip(text)
    number = F.when((cell != MISSING) & cell.rlike(NUMBER), cell.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def region_level(code: Column) -> Column:
    """0 country, 1 and 2 for the regional levels, 3 for every other code length."""
    size = F.length(strip(code))
    return (
        F.when(size == 2, F.lit(0)).when(size == 3, F.lit(1)).when(size == 4, F.lit(2)).otherwise(F.lit(3))
    )


def level_name(level: Column) -> Column:
    return (
        F.when(level == 0, "Country")
        .when(level == 1, "NUTS1")
        .when(level == 2, "NUTS2")
        .otherwise("NUTS3+")
    )


def is_leap_year(year: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return leap.cast("int")


def decade(year: Column) -> Column:
    return year - F.pmod(year, F.lit(10))


def icd10_is_respiratory(code: Column) -> Column:
    return code.startswith("J").cast("int")


def title_label(text: Column, drop: tuple[str, ...] = ()) -> Column:
    """Column name to display label: listed parts removed, underscores to blanks, words capitalised."""
    for part in drop:
        text = F.replace(text, F.lit(part), F.lit(""))
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))

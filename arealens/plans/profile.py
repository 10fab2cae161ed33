"""Profiles of raw and tidy sources: coverage, missing cells, completeness."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import level_name, percentage, region_level
from ..functions.codes import MISSING, strip
from ..operators import first_per_group, only_level, overlap_summary, standard_stratum, split_dimensions, year_columns
from ..operators.filters import POPULATION_STRATUM
from ..schemas import SOURCE_ORDER
from .tidy import find_geo_column


def _valid(cell: Column) -> Column:
    return cell.isNotNull() & (strip(cell) != MISSING)


def raw_dimensions(df: DataFrame) -> DataFrame:
    """The wide raw table with its composite column split and the region column named ``geo``."""
    names = df.columns[0].split(",")
    split = split_dimensions(df, df.columns[0], names)
    return split.withColumnRenamed(find_geo_column(names), "geo")


def _stats(row: DataFrame, source: str) -> DataFrame:
    """One-row table of numbers -> ``(source, stat, value)``."""
    doubles = row.select(*[F.col(c).cast("double").alias(c) for c in row.columns])
    return doubles.unpivot([], row.columns, "stat", "value").select(F.lit(source).alias("source"), "stat", "value")


def _distinct_counts(df: DataFrame, columns: list[str], distinct: Mapping[str, str]) -> tuple[DataFrame, list[Column]]:
    """Row counts per combination of the columns, and the aggregates over those combinations.

    Several distinct counts over the rows would make Spark copy every row once per count; over the
    few combinations of codes the copies do not matter.
    """
    combinations = df.groupBy(*dict.fromkeys(columns)).agg(F.count(F.lit(1)).alias("_n"))
    counts = [
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        *[F.count_distinct(c).alias(name) for name, c in distinct.items()],
    ]
    return combinations, counts


def source_summary(df: DataFrame, source: str, distinct: Mapping[str, str]) -> DataFrame:
    """Rows, years of the headers, and distinct values of chosen columns of a wide raw table.

    ``distinct`` maps the reported name to the column. Region codes are also counted at level 2.
    """
    raw = raw_dimensions(df)
    years = sorted(year_columns(raw.columns).values())
    combinations, counts = _distinct_counts(raw, [*distinct.values(), "geo"], distinct)
    row = combinations.agg(
        *counts,
        F.count_distinct(F.when(F.length("geo") == 4, F.col("geo"))).alias("level2_codes"),
        F.lit(years[0]).alias("first_year"),
        F.lit(years[-1]).alias("last_year"),
        F.lit(len(years)).alias("n_years"),
    )
    return _stats(row, source)


def sheet_summary(df: DataFrame, source: str) -> DataFrame:
    """The same for a raw emission sheet; codes are counted over the rows that have a region."""
    years = sorted(year_columns(df.columns, r"Y_(\d{4})").values())
    distinct = {"regions": "NUTS 2", "countries": "ISO", "sectors": "Sector"}
    combinations = df.groupBy(*[F.col(f"`{c}`") for c in distinct.values()]).agg(F.count(F.lit(1)).alias("_n"))
    located = F.col("`NUTS 2`").isNotNull()
    row = combinations.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        *[F.count_distinct(F.when(located, F.col(f"`{c}`"))).alias(name) for name, c in distinct.items()],
        F.lit(years[0]).alias("first_year"),
        F.lit(years[-1]).alias("last_year"),
        F.lit(len(years)).alias("n_years"),
    )
    return _stats(row, source)


def tidy_summary(df: DataFrame, source: str, distinct: Mapping[str, str]) -> DataFrame:
    """The same summary for a tidy table, where the years are rows."""
    combinations, counts = _distinct_counts(df, [*distinct.values(), "year"], distinct)
    row = combinations.agg(
        *counts,
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count_distinct("year").alias("n_years"),
    )
    return _stats(row, source)


def missing_cells(df: DataFrame, source: str, pattern: str, last: int = 10) -> DataFrame:
    """Empty cells of the last year columns, absolute and as a share of all their cells."""
    columns = list(year_columns(df.columns, pattern))[-last:]
    row = df.agg(
        sum((F.count_if(F.col(f"`{c}`").isNull()) for c in columns), F.lit(0)).alias("missing_values"),
        F.count(F.lit(1)).alias("_rows"),
    ).select(
        "missing_values",
        F.coalesce(percentage(F.col("missing_values"), F.col("_rows") * len(columns)), F.lit(0.0)).alias("missing_pct"),
    )
    return _stats(row, source)


def completeness(
    df: DataFrame, last: int = 5, stratum: Mapping[str, str] | None = None, level: int | None = None
) -> DataFrame:
    """Valid cells per year over the last years of a wide raw table.

    ``stratum`` and ``level`` restrict the rows first. The year columns are counted side by side in
    one aggregation and only the single result row is turned into rows.
    """
    raw = raw_dimensions(df)
    if stratum:
        raw = standard_stratum(raw, stratum)
    raw = only_level(raw, level, "geo")
    years = sorted(year_columns([c for c in raw.columns if c != SOURCE_ORDER]).items(), key=lambda item: item[1])[-last:]
    row = raw.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_valid(F.col(f"`{c}`"))).alias(str(year)) for c, year in years],
    )
    long = row.unpivot(["_rows"], [str(year) for _, year in years], "year", "valid")
    return long.select(
        F.col("year").cast("int").alias("year"),
        "valid",
        F.col("_rows").alias("total"),
        percentage(F.col("valid"), F.col("_rows")).alias("valid_pct"),
    )


def population_completeness(df: DataFrame, last: int = 5) -> DataFrame:
    """Completeness of the level-2 annual totals."""
    return completeness(df, last, POPULATION_STRATUM, level=2)


def code_levels(df: DataFrame, code: str = "nuts_id") -> DataFrame:
    """Rows and distinct codes by code length, as codes are stored.

    Counting per code first leaves one row per code for the second step.
    """
    per_code = df.groupBy(code).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_code.filter(F.col(code).isNotNull())
        .groupBy(F.length(code).alias("code_length"))
        .agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_codes"))
        .orderBy("code_length")
    )


def named_levels(df: DataFrame, code: str = "geo") -> DataFrame:
    """Rows and distinct codes by level name."""
    per_code = df.groupBy(code).agg(F.count(F.lit(1)).alias("n"))
    level = level_name(region_level(F.coalesce(F.col(code), F.lit("")))).alias("level_name")
    return per_code.groupBy(level).agg(F.sum("n").alias("n_rows"), F.count(code).alias("n_codes"))


def code_sample(df: DataFrame, code: str = "nuts_id", n: int = 5) -> DataFrame:
    """The first codes of each code length in code order."""
    codes = df.select(F.col(code).alias("code")).filter("code IS NOT NULL").distinct()
    lengths = codes.withColumn("code_length", F.length("code"))
    return first_per_group(lengths, ["code_length"], "code", n).orderBy("code_length", "code")


def respiratory_codes(df: DataFrame, code: str = "icd10_group") -> DataFrame:
    """Distinct cause codes that start with J or mention "resp"."""
    c = F.col(code)
    return df.select(c.alias("code")).distinct().filter(
        F.col("code").startswith("J") | F.lower("code").contains("resp")
    )


def region_overlap(
    sources: Mapping[str, DataFrame], level: int = 2, code: str = "nuts_id", all_levels: tuple[str, ...] = ()
) -> DataFrame:
    """Distinct codes of one level per source, per pair of sources, in any and in all sources.

    Sources named in ``all_levels`` count with all their codes.
    """
    sets = {
        name: df if name in all_levels else only_level(df.filter(F.col(code).isNotNull()), level, code)
        for name, df in sources.items()
    }
    return overlap_summary(sets, code).select("measure", F.col("n").alias("n_codes"))


def harmonization_window(sources: Mapping[str, DataFrame]) -> DataFrame:
    """First year, last year and number of years per source, per pair, in any and in all sources.

    The row ``intersection`` is the window in which every source has data.
    """
    return overlap_summary(sources, "year").select(
        "measure", F.col("first").alias("first_year"), F.col("last").alias("last_year"), F.col("n").alias("n_years")
    )

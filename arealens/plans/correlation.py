"""Emissions against respiratory mortality.

Both facts are aggregated on their integer keys to region and year before they meet and before any
name is joined, so every join is one row to one row (or one region-year to its few sectors), and a
region with very many fact rows costs no more to join than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_avg, exact_sum, pearson
from ..operators import between_years, top_n
from .warehouse import Star

KEYS = ["geography_id", "time_id"]


def _emissions(star: Star, *more: str) -> DataFrame:
    fact = star.fact_emissions
    if more:
        fact = fact.join(star.dim_sector.select("sector_id", *more), "sector_id")
    return fact.groupBy(*KEYS, *more).agg(exact_sum(F.col("emissions_kt_co2e")).alias("total_emissions"))


def _mortality(star: Star) -> DataFrame:
    respiratory = star.dim_icd10_cod.filter("is_respiratory = 1").select("icd10_cod_id")
    rows = star.fact_causes_of_death.join(respiratory, "icd10_cod_id", "left_semi")
    return rows.groupBy(*KEYS).agg(exact_avg(F.col("age_standardised_rate_per_100k")).alias("avg_death_rate"))


def _named(star: Star, pairs: DataFrame) -> DataFrame:
    regions = star.dim_geography.select("geography_id", "nuts_id", "country_name", "nuts_label")
    years = star.dim_time.select("time_id", "year")
    return pairs.join(regions, "geography_id").join(years, "time_id").drop(*KEYS)


def region_year_pairs(star: Star) -> DataFrame:
    """Total emissions and mean respiratory death rate per region and year, where both exist."""
    pairs = _named(star, _emissions(star).join(_mortality(star), KEYS))
    return pairs.select("nuts_id", "country_name", "nuts_label", "year", "total_emissions", "avg_death_rate")


def country_matrix(pairs: DataFrame) -> DataFrame:
    """Both measures side by side per country."""
    return pairs.groupBy("country_name").agg(
        exact_sum(F.col("total_emissions")).alias("total_emissions"),
        exact_avg(F.col("avg_death_rate")).alias("avg_death_rate"),
    )


def pearson_by(pairs: DataFrame, column: str) -> DataFrame:
    """Correlation and number of pairs per value of a column (country, sector group)."""
    return pairs.groupBy(column).agg(
        F.count(F.lit(1)).alias("n_pairs"), pearson(F.col("total_emissions"), F.col("avg_death_rate")).alias("pearson")
    )


def pearson_overall(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count(F.lit(1)).alias("n_pairs"), pearson(F.col("total_emissions"), F.col("avg_death_rate")).alias("pearson")
    )


def yearly_comparison(
    emissions: DataFrame, health: DataFrame, years: tuple[int, int] | None = (2000, 2021)
) -> DataFrame:
    """Country-level emissions and mean death rate per year, for the years both views have."""
    first, last = years or (None, None)

    def country_rows(view: DataFrame) -> DataFrame:
        return between_years(view.filter("nuts_level = 0"), first, last).groupBy("year")

    kt = country_rows(emissions).agg(exact_sum(F.col("emissions_kt_co2e")).alias("total_emissions"))
    rate = country_rows(health.filter("is_respiratory = 1")).agg(
        exact_avg(F.col("age_standardised_rate_per_100k")).alias("avg_death_rate")
    )
    return kt.join(rate, "year")


def top_regions(pairs: DataFrame, n: int = 10) -> DataFrame:
    """The regions with the highest emissions and their mean death rate."""
    totals = pairs.groupBy("nuts_label", "country_name").agg(
        exact_sum(F.col("total_emissions")).alias("total_emissions"),
        exact_avg(F.col("avg_death_rate")).alias("avg_death_rate"),
    )
    return top_n(totals, "total_emissions", n, ("nuts_label", "country_name"))


def sector_pairs(star: Star) -> DataFrame:
    """Emissions per sector group against the region's mean death rate of the year."""
    pairs = _named(star, _emissions(star, "sector_group").join(_mortality(star), KEYS))
    return pairs.select("nuts_id", "country_name", "year", "sector_group", "total_emissions", "avg_death_rate")


def lagged_pairs(star: Star, lag_years: int = 1) -> DataFrame:
    """Emissions of a year with the death rate ``lag_years`` earlier.

    The health year is shifted and joined for equality, so a gap in either series yields no pair; a
    window ``lag`` would pair across the gap. A negative lag looks at later death rates.
    """
    shifted = _mortality(star).withColumn("time_id", F.col("time_id") + lag_years)
    pairs = _named(star, _emissions(star).join(shifted, KEYS))
    return pairs.select(
        "nuts_id",
        "country_name",
        "year",
        F.col("total_emissions").alias("emissions"),
        F.col("avg_death_rate").alias("death_rate_prev_year"),
    )


def lag_by_year(pairs: DataFrame) -> DataFrame:
    """Both lines of the lag chart."""
    return pairs.groupBy("year").agg(
        exact_sum(F.col("emissions")).alias("emissions"),
        exact_avg(F.col("death_rate_prev_year")).alias("death_rate_prev_year"),
    )

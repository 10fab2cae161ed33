"""The standard report queries over the star schema.

Facts are filtered and aggregated on their keys first; names are joined to the reduced rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_exact, exact_avg, exact_sum
from ..operators import between_years
from .warehouse import Star

REGION_YEAR = ["geography_id", "time_id"]


def _of_years(star: Star, fact: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Fact rows of the years with the year attached.

    The time key is the year, so the range also filters the fact itself, in its scan.
    """
    years = between_years(star.dim_time, first, last).select("time_id", "year")
    return between_years(fact, first, last, "time_id").join(years, "time_id")


def emissions_by_country_year(star: Star) -> DataFrame:
    per_region = star.fact_emissions.groupBy(*REGION_YEAR).agg(F.sum(as_exact(F.col("emissions_kt_co2e"))).alias("_kt"))
    return (
        _of_years(star, per_region)
        .join(star.dim_geography.select("geography_id", "country_name"), "geography_id")
        .groupBy("country_name", "year")
        .agg(F.sum("_kt").cast("double").alias("total_emissions_kt"))
        .orderBy("country_name", "year")
    )


def respiratory_rates(star: Star, year: int) -> DataFrame:
    """Respiratory death rates of one year, highest first."""
    causes = star.dim_icd10_cod.filter("is_respiratory = 1").select("icd10_cod_id", "icd10_name")
    return (
        _of_years(star, star.fact_causes_of_death, year, year)
        .join(causes, "icd10_cod_id")
        .join(star.dim_geography.select("geography_id", "nuts_label", "country_name"), "geography_id")
        .select("nuts_label", "country_name", "icd10_name", "age_standardised_rate_per_100k")
        .orderBy(F.desc("age_standardised_rate_per_100k"), "nuts_label", "icd10_name")
    )


def emissions_against_mortality(star: Star, first_year: int, last_year: int, cause: str = "J") -> DataFrame:
    """Total emissions and the death rate of one cause per region and year.

    The cause is looked up in its dimension first, so only its rows of the fact are joined; that
    grain is unique, hence no further grouping by the rate.
    """
    emissions = (
        _of_years(star, star.fact_emissions, first_year, last_year)
        .groupBy(*REGION_YEAR, "year")
        .agg(exact_sum(F.col("emissions_kt_co2e")).alias("total_emissions_kt"))
    )
    wanted = star.dim_icd10_cod.filter(F.col("icd10_code") == cause).select("icd10_cod_id")
    rates = between_years(star.fact_causes_of_death, first_year, last_year, "time_id")
    rates = rates.join(wanted, "icd10_cod_id", "left_semi").select(
        *REGION_YEAR, F.col("age_standardised_rate_per_100k").alias("cod_all_resp_rate")
    )
    return (
        emissions.join(rates, REGION_YEAR, "left")
        .join(star.dim_geography.select("geography_id", "nuts_id", "nuts_label"), "geography_id")
        .select("nuts_id", "nuts_label", "year", "total_emissions_kt", "cod_all_resp_rate")
        .orderBy("nuts_id", "year")
    )


def per_capita_by_sector(star: Star, year: int) -> DataFrame:
    """Emissions and population by sector in one year.

    The population counts once per emission row, that is once per region and gas. Emission rows are
    reduced to region and sector with their number, which gives the same sums from fewer join rows.
    """
    reduced = (
        _of_years(star, star.fact_emissions, year, year)
        .groupBy(*REGION_YEAR, "sector_id")
        .agg(F.sum(as_exact(F.col("emissions_kt_co2e"))).alias("_kt"), F.count(F.lit(1)).alias("_rows"))
    )
    people = between_years(star.fact_population, year, year, "time_id").select(*REGION_YEAR, "population")
    totals = (
        reduced.join(people, REGION_YEAR)
        .join(star.dim_sector.select("sector_id", "sector_name", "sector_group"), "sector_id")
        .groupBy("sector_name", "sector_group")
        .agg(
            F.sum("_kt").cast("double").alias("total_emissions_kt"),
            F.sum(F.col("population") * F.col("_rows")).alias("total_population"),
        )
    )
    ratio = F.try_divide(F.col("total_emissions_kt") * 1000.0, F.col("total_population").cast("double"))
    return totals.withColumn("emissions_per_capita_tonnes", ratio).orderBy(
        F.desc_nulls_last("emissions_per_capita_tonnes"), "sector_name"
    )


def discharge_rates_by_country(star: Star, year: int) -> DataFrame:
    """Respiratory discharges and mean rate by country and type in one year."""
    types = star.dim_discharge_type.filter("is_respiratory = 1").select("discharge_type_id", "discharge_name")
    return (
        _of_years(star, star.fact_hospital_discharges, year, year)
        .join(types, "discharge_type_id")
        .join(star.dim_geography.select("geography_id", "country_name"), "geography_id")
        .groupBy("country_name", "discharge_name")
        .agg(
            exact_sum(F.col("discharge_count")).alias("total_discharges"),
            exact_avg(F.col("discharge_rate_per_100k")).alias("avg_rate_per_100k"),
        )
        .orderBy("country_name", F.desc_nulls_last("avg_rate_per_100k"), "discharge_name")
    )

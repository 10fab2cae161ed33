"""Chart and card queries of the report pages, over the joined views.

The functions take a view, so any slicer (``slice_rows``) applies before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_exact, exact_avg, exact_sum, percentage, safe_divide
from ..operators import top_n

def _kt() -> Column:
    return F.col("emissions_kt_co2e")


def _respiratory(df: DataFrame) -> DataFrame:
    return df.filter("is_respiratory = 1")


def _countries(df: DataFrame) -> DataFrame:
    return df.filter("nuts_level = 0")


def _mean_of_parts(total: str, n: str) -> Column:
    return F.try_divide(F.sum(total).cast("double"), F.sum(n).cast("double"))


# --- emissions page ---------------------------------------------------------------------------


def emissions_by_country(emissions: DataFrame) -> DataFrame:
    """Country-level rows only: the part of a country's emissions not assigned to a region."""
    return _countries(emissions).groupBy("country_name").agg(exact_sum(_kt()).alias("total_emissions_kt"))


def emissions_by_year(emissions: DataFrame) -> DataFrame:
    return _countries(emissions).groupBy("year").agg(exact_sum(_kt()).alias("total_emissions_kt"))


def emissions_trend_top_countries(emissions: DataFrame, n: int = 5) -> DataFrame:
    """Yearly emissions of the countries with the highest totals.

    Totals and trend share one aggregation; the ranking runs over its few rows.
    """
    trend = _countries(emissions).groupBy("country_name", "year").agg(F.sum(as_exact(_kt())).alias("_kt"))
    totals = trend.groupBy("country_name").agg(F.sum("_kt").alias("_total"))
    best = top_n(totals, "_total", n, ("country_name",)).select("country_name")
    return trend.join(best, "country_name", "left_semi").select(
        "country_name", "year", F.col("_kt").cast("double").alias("total_emissions_kt")
    )


def emissions_by_sector_year(emissions: DataFrame) -> DataFrame:
    return (
        emissions.groupBy("year", "sector_group")
        .agg(exact_sum(_kt()).alias("total_emissions_kt"))
        .orderBy("year", F.desc("total_emissions_kt"), "sector_group")
    )


def gas_shares(emissions: DataFrame) -> DataFrame:
    """Emissions and percentage per gas; the grand total is a sum over the few gas rows."""
    totals = emissions.groupBy("gas_name").agg(F.sum(as_exact(_kt())).alias("_kt"))
    grand = totals.agg(F.sum("_kt").cast("double")).scalar()
    kt = F.col("_kt").cast("double")
    return totals.select("gas_name", kt.alias("total_emissions_kt"), percentage(kt, grand).alias("share_pct"))


def top_emitting_regions(emissions: DataFrame, n: int = 10) -> DataFrame:
    totals = emissions.groupBy("nuts_label", "country_name").agg(exact_sum(_kt()).alias("total_emissions_kt"))
    return top_n(totals, "total_emissions_kt", n, ("nuts_label", "country_name"))


def top_emitting_countries(emissions: DataFrame, n: int = 5) -> DataFrame:
    return top_n(emissions_by_country(emissions), "total_emissions_kt", n, ("country_name",))


# --- health page ------------------------------------------------------------------------------


def _rate() -> Column:
    return F.col("age_standardised_rate_per_100k")


def death_rate_by_country(health: DataFrame) -> DataFrame:
    rows = _countries(_respiratory(health))
    return rows.groupBy("country_name").agg(exact_avg(_rate()).alias("avg_death_rate"))


def death_rate_by_year(health: DataFrame) -> DataFrame:
    return _countries(_respiratory(health)).groupBy("year").agg(exact_avg(_rate()).alias("avg_death_rate"))


def death_rate_trend_top_countries(health: DataFrame, n: int = 5) -> DataFrame:
    """Yearly mean rate of the countries with the highest mean over all years."""
    trend = (
        _countries(_respiratory(health))
        .groupBy("country_name", "year")
        .agg(F.sum(as_exact(_rate())).alias("_sum"), F.count(_rate()).alias("_n"))
    )
    means = trend.groupBy("country_name").agg(_mean_of_parts("_sum", "_n").alias("_mean"))
    best = top_n(means, "_mean", n, ("country_name",)).select("country_name")
    mean = F.try_divide(F.col("_sum").cast("double"), F.col("_n").cast("double"))
    return trend.join(best, "country_name", "left_semi").select("country_name", "year", mean.alias("avg_death_rate"))


def death_rate_by_category(health: DataFrame) -> DataFrame:
    rows = _countries(_respiratory(health))
    return rows.groupBy("year", "icd10_category", "icd10_name").agg(exact_avg(_rate()).alias("avg_death_rate"))


def discharge_rate_by_country(discharges: DataFrame) -> DataFrame:
    return (
        _countries(_respiratory(discharges))
        .groupBy("country_name")
        .agg(exact_avg(F.col("discharge_rate_per_100k")).alias("avg_discharge_rate"))
        .orderBy(F.desc_nulls_last("avg_discharge_rate"), "country_name")
    )


def top_death_rate_regions(health: DataFrame, n: int = 10) -> DataFrame:
    rates = _respiratory(health).groupBy("nuts_label", "country_name").agg(exact_avg(_rate()).alias("avg_death_rate"))
    return top_n(rates, "avg_death_rate", n, ("nuts_label", "country_name"))


def top_death_rate_countries(health: DataFrame, n: int = 5) -> DataFrame:
    return top_n(death_rate_by_country(health), "avg_death_rate", n, ("country_name",))


# --- overview page and measures ---------------------------------------------------------------


def _cards(row: DataFrame) -> DataFrame:
    doubles = row.select(*[F.col(c).cast("double").alias(c) for c in row.columns])
    return doubles.unpivot([], row.columns, "card", "value")


def overview_cards(emissions: DataFrame, health: DataFrame) -> DataFrame:
    """Headline numbers ``(card, value)``: totals, mean rate, regions and year coverage."""
    kt = emissions.agg(
        exact_sum(_kt()).alias("total_emissions_kt"),
        F.count_distinct("nuts_id").alias("n_regions"),
        F.min("year").alias("emissions_first_year"),
        F.max("year").alias("emissions_last_year"),
    )
    rate = health.agg(
        exact_avg(F.when(F.col("is_respiratory") == 1, _rate())).alias("avg_resp_death_rate"),
        F.min("year").alias("health_first_year"),
        F.max("year").alias("health_last_year"),
    )
    return _cards(kt).unionByName(_cards(rate))


def measures(emissions: DataFrame, health: DataFrame, discharges: DataFrame, population: DataFrame) -> DataFrame:
    """The reusable measures as ``(card, value)``; filtered measures test the flag inside."""
    resp = F.col("is_respiratory") == 1
    people = population.agg(F.sum("population").cast("double")).scalar()
    total = emissions.agg(exact_sum(_kt()).alias("total_emissions")).withColumn(
        "emissions_per_capita", safe_divide(F.col("total_emissions"), people)
    )
    rate = health.agg(exact_avg(F.when(resp, _rate())).alias("avg_respiratory_death_rate"))
    beds = discharges.agg(
        exact_sum(F.when(resp, F.col("discharge_count"))).alias("total_hospital_discharges"),
        exact_avg(F.when(resp, F.col("discharge_rate_per_100k"))).alias("avg_hospital_discharge_rate"),
    )
    return _cards(total).unionByName(_cards(rate)).unionByName(_cards(beds))

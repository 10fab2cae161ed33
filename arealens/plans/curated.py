"""One row per region and year with emissions, population, health metrics and rates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_exact, exact_avg, per_100k, per_capita_tonnes
from ..operators import between_years, conditional_columns, drop_null_codes, only_level, standard_stratum
from ..operators.filters import HEALTH_STRATUM
from ..schemas import DISCHARGE_METRICS, MORTALITY_METRICS, SECTOR_GROUP_NAMES, SOURCE_ORDER

KEYS = ["nuts_id", "year"]
REGION_LABELS = ["nuts_label", "country_iso", "country_name"]


def sector_column(group: str) -> str:
    return f"emissions_{group}_kt"


def _first_label(label: str, order: str | None):
    known = F.col(label).isNotNull()
    if order:
        return F.min_by(F.when(known, F.col(label)), F.when(known, F.col("_first"))).alias(label)
    return F.min(label).alias(label)


def emissions_by_region_year(emissions: DataFrame) -> DataFrame:
    """Total and per-group emissions with the first known label, country code and country name.

    Rows are first reduced to one per region, year, label combination and sector group with a single
    sum; totals, groups and labels then come from one aggregation over those few rows. Labels are
    grouping keys in the first step because a string aggregate would force Spark from hash to sort
    aggregation over all rows.
    """
    order = SOURCE_ORDER if SOURCE_ORDER in emissions.columns else None
    reduced = (
        drop_null_codes(emissions, *KEYS)
        .groupBy(*KEYS, *REGION_LABELS, "sector_group")
        .agg(
            F.sum(as_exact(F.col("emissions_kt_co2e"))).alias("_kt"),
            *([F.min(order).alias("_first")] if order else []),
        )
    )

    def total(kt):
        return F.coalesce(F.sum(kt).cast("double"), F.lit(0.0))

    return reduced.groupBy(*KEYS).agg(
        *[_first_label(label, order) for label in REGION_LABELS],
        total(F.col("_kt")).alias("total_emissions_kt"),
        *[
            total(F.when(F.col("sector_group") == group, F.col("_kt"))).alias(sector_column(group))
            for group in SECTOR_GROUP_NAMES
        ],
    )


def health_by_region_year(df: DataFrame, metrics: Mapping[str, str], value: str) -> DataFrame:
    """Mean value of each mapped ICD-10 group as one column per metric (annual totals only)."""
    rows = standard_stratum(df, HEALTH_STRATUM, codes=metrics)
    return drop_null_codes(rows, *KEYS).groupBy(*KEYS).agg(
        *conditional_columns("icd10_group", metrics, exact_avg, value)
    )


def mortality_by_region_year(causes: DataFrame) -> DataFrame:
    return health_by_region_year(causes, MORTALITY_METRICS, "age_standardised_rate_per_100k")


def discharges_by_region_year(discharges: DataFrame) -> DataFrame:
    return health_by_region_year(discharges, DISCHARGE_METRICS, "discharges")


def curated(
    emissions: DataFrame,
    causes: DataFrame,
    discharges: DataFrame,
    population: DataFrame,
    level_only: int | None = 2,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Curated table: emissions with a known population, mortality and discharges where there are any.

    ``years`` limits every source to a harmonization window. Each source is aggregated to the join keys before it is joined, so the joins see one row per
    region and year and reuse the partitioning of the aggregations.
    """

    def wanted(df: DataFrame) -> DataFrame:
        return only_level(between_years(df, *years) if years else df, level_only)

    people = population.select(
        F.col("geo").alias("nuts_id"), "year", F.col("population").cast("double").alias("population")
    )
    joined = (
        emissions_by_region_year(wanted(emissions))
        .join(drop_null_codes(wanted(people), *KEYS), KEYS, "inner")
        .join(mortality_by_region_year(wanted(causes)), KEYS, "left")
        .join(discharges_by_region_year(wanted(discharges)), KEYS, "left")
    )
    head = F.col("population")
    rates = {"emissions_per_capita_tonnes": per_capita_tonnes(F.col("total_emissions_kt"), head)} | {
        f"{c}_per_100k": per_100k(F.col(c), head) for c in DISCHARGE_METRICS.values()
    }
    return joined.withColumns(rates)

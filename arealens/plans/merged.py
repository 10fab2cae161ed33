"""Region-year view over all facts, with a row for every region and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum
from ..schemas import MORTALITY_METRICS, SECTOR_GROUP_NAMES
from .curated import sector_column
from .warehouse import Star

KEYS = ["geography_id", "time_id"]


def region_years(star: Star) -> DataFrame:
    """Every region with every year.

    The years of the time dimension are one small array (a scalar subquery) exploded per region:
    the result has regions x years rows by definition, and is produced without a join.
    """
    years = star.dim_time.agg(F.array_sort(F.collect_set("time_id"))).scalar()
    regions = star.dim_geography.select("geography_id", "nuts_id", "nuts_label", "country_iso", "country_name")
    return regions.withColumn("time_id", F.explode(years))


def vw_merged(star: Star) -> DataFrame:
    """Population, sector emissions and mortality per region and year.

    Each fact is aggregated to the region-year before it is joined, so no measure is multiplied by
    the rows of another fact.
    """
    kt = F.col("emissions_kt_co2e")
    emissions = (
        star.fact_emissions.join(star.dim_sector.select("sector_id", "sector_group"), "sector_id")
        .groupBy(*KEYS)
        .agg(
            exact_sum(kt).alias("total_emissions_kt"),
            *[
                exact_sum(F.when(F.col("sector_group") == g, kt)).alias(sector_column(g))
                for g in SECTOR_GROUP_NAMES
            ],
        )
    )
    rate = F.col("age_standardised_rate_per_100k")
    causes = (
        star.fact_causes_of_death.join(star.dim_icd10_cod.select("icd10_cod_id", "icd10_code"), "icd10_cod_id")
        .filter(F.col("icd10_code").isin(*MORTALITY_METRICS))
        .groupBy(*KEYS)
        .agg(
            *[
                F.max(F.when(F.col("icd10_code") == code, rate)).alias(name)
                for code, name in MORTALITY_METRICS.items()
            ]
        )
    )
    people = star.fact_population.select(*KEYS, "population")
    joined = region_years(star).join(people, KEYS, "left").join(emissions, KEYS, "left").join(causes, KEYS, "left")
    return joined.select(
        "nuts_id",
        "nuts_label",
        "country_iso",
        "country_name",
        F.col("time_id").alias("year"),
        "population",
        *[F.coalesce(sector_column(g), F.lit(0.0)).alias(sector_column(g)) for g in SECTOR_GROUP_NAMES],
        "total_emissions_kt",
        *MORTALITY_METRICS.values(),
    )

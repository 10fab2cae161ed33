"""Star schema: six dimensions, four facts and three joined views.

Facts hold one row per grain, so they are reduced (map-side first) before any key lookup. The
lookups are plain equi-joins without a broadcast hint: the dimensions are read from stored tables
of known size or measured at run time, and Spark broadcasts them only below its size threshold and
otherwise joins by shuffle, splitting skewed keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    decade,
    gas_info,
    icd10_category,
    icd10_description,
    icd10_is_respiratory,
    icd10_name,
    is_leap_year,
    per_100k,
    region_level,
    round_half_even,
)
from ..operators import dense_ids, drop_null_codes, keep_first, only_level, standard_stratum
from ..operators.filters import HEALTH_STRATUM
from ..schemas import SOURCE_ORDER


@dataclass(frozen=True)
class Tidy:
    """The four tidy sources."""

    emissions: DataFrame
    causes: DataFrame
    discharges: DataFrame
    population: DataFrame

    def at_level(self, level: int | None) -> Tidy:
        return Tidy(
            only_level(self.emissions, level),
            only_level(self.causes, level),
            only_level(self.discharges, level),
            only_level(self.population, level, "geo"),
        )


# --- dimensions -------------------------------------------------------------------------------


def _region_attributes(emissions: DataFrame) -> DataFrame:
    """First label and first located country per region, from the emission rows."""
    attributes = ["nuts_label", "country_iso", "country_name"]
    rows = drop_null_codes(emissions, "nuts_id")
    # Distinct attribute sets first (hash aggregation), then the first of the few sets per region.
    if SOURCE_ORDER in emissions.columns:
        distinct = rows.groupBy("nuts_id", *attributes).agg(F.min(SOURCE_ORDER).alias("_ord"))
    else:
        distinct = rows.select("nuts_id", *attributes).distinct().withColumn("_ord", F.struct(*attributes))
    country = F.struct("country_iso", "country_name")
    located = F.col("country_iso").isNotNull()
    return (
        distinct.groupBy("nuts_id")
        .agg(
            F.min_by(F.struct("nuts_label"), "_ord").alias("_label"),
            F.min_by(F.when(located, country), F.when(located, F.col("_ord"))).alias("_country"),
        )
        .select("nuts_id", "_label.nuts_label", "_country.country_iso", "_country.country_name")
    )


def region_universe(tidy: Tidy) -> DataFrame:
    """Every region code of the four sources with the attributes known from emissions.

    Attributes come from emissions only; codes that occur elsewhere have none.
    """
    known = _region_attributes(tidy.emissions).withColumn("_source", F.lit(0))
    others = [
        drop_null_codes(df, column).select(F.col(column).alias("nuts_id")).distinct()
        for df, column in ((tidy.causes, "nuts_id"), (tidy.discharges, "nuts_id"), (tidy.population, "geo"))
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, known)
    first = F.struct("nuts_label", "country_iso", "country_name")
    return (
        union.withColumn("_source", F.coalesce("_source", F.lit(1)))
        .groupBy("nuts_id")
        .agg(F.min_by(first, "_source").alias("_first"))
        .select("nuts_id", "_first.*")
    )


def dim_geography(emissions: DataFrame, level_only: int | None = None) -> DataFrame:
    """Regions with a country, numbered in code order.

    Only emission rows carry a country, so regions known from health or population alone never
    qualify; reading the emissions gives the same rows as filtering ``region_universe``.
    Empty labels are filled with the country name (countries) or the code.
    """
    regions = _region_attributes(emissions).withColumn("nuts_level", region_level(F.col("nuts_id")))
    if level_only is not None:
        regions = regions.filter(F.col("nuts_level") == level_only)
    filled = F.coalesce(
        F.nullif(F.col("nuts_label"), F.lit("")),
        F.when(F.col("nuts_level") == 0, F.nullif(F.col("country_name"), F.lit(""))),
        F.col("nuts_id"),
    )
    located = regions.dropna(subset=["country_iso"]).withColumn("nuts_label", filled)
    return dense_ids(
        located.select("nuts_id", "nuts_label", "nuts_level", "country_iso", "country_name"),
        "nuts_id",
        "geography_id",
    )


def all_years(tidy: Tidy) -> DataFrame:
    """Distinct years of the four sources."""
    parts = [
        df.select("year").dropna().distinct()
        for df in (tidy.emissions, tidy.causes, tidy.discharges, tidy.population)
    ]
    return reduce(DataFrame.unionAll, parts).distinct()


def dim_time(tidy: Tidy) -> DataFrame:
    """Annual calendar; the availability flags are set by ``with_availability``."""
    year = F.col("year")
    return all_years(tidy).select(
        year.alias("time_id"),
        year,
        decade(year).alias("decade"),
        year.cast("string").alias("year_label"),
        is_leap_year(year).alias("is_leap_year"),
        F.lit(4).alias("quarter"),
    )


def with_availability(times: DataFrame, emissions: DataFrame, causes: DataFrame, population: DataFrame) -> DataFrame:
    """Set the 0/1 flags of the years that occur in the facts."""
    facts = {"is_emissions_available": emissions, "is_health_available": causes, "is_population_available": population}
    for flag, fact in facts.items():
        present = fact.select("time_id").distinct().withColumn(flag, F.lit(1))
        times = times.join(present, "time_id", "left").withColumn(flag, F.coalesce(flag, F.lit(0)))
    return times


def dim_sector(emissions: DataFrame) -> DataFrame:
    sectors = (
        drop_null_codes(emissions, "sector")
        .select(F.col("sector").alias("sector_code"), "sector_group")
        .distinct()
        .groupBy("sector_code")
        .agg(F.min("sector_group").alias("sector_group"))
        .dropna(subset=["sector_group"])
    )
    return dense_ids(sectors, "sector_code", "sector_id").select(
        "sector_id",
        "sector_code",
        F.col("sector_code").alias("sector_name"),
        "sector_group",
        F.lit(None).cast("string").alias("sector_description"),
        F.lit(1).alias("is_active"),
    )


def _numbered_codes(df: DataFrame, column: str, code: str, key: str) -> DataFrame:
    """Distinct codes of a column with their key. Attributes are derived afterwards, per code."""
    codes = drop_null_codes(df, column).select(F.col(column).alias(code)).distinct()
    return dense_ids(codes, code, key)


def dim_gas(emissions: DataFrame) -> DataFrame:
    gases = _numbered_codes(emissions, "gas", "gas_code", "gas_id")
    return gases.withColumn("_info", gas_info(F.col("gas_code"))).select(
        "gas_id", "gas_code", "_info.*", F.lit(1).alias("is_active")
    )


def _described(codes: DataFrame, code: str) -> DataFrame:
    return codes.withColumns({"_name": icd10_name(F.col(code)), "_category": icd10_category(F.col(code))})


def dim_icd10_cod(causes: DataFrame) -> DataFrame:
    codes = _numbered_codes(causes, "icd10_group", "icd10_code", "icd10_cod_id")
    return _described(codes, "icd10_code").select(
        "icd10_cod_id",
        "icd10_code",
        F.col("_name").alias("icd10_name"),
        F.col("_category").alias("icd10_category"),
        icd10_description(F.col("_name"), F.col("_category")).alias("icd10_description"),
        icd10_is_respiratory(F.col("icd10_code")).alias("is_respiratory"),
        F.lit(1).alias("is_active"),
    )


def dim_discharge_type(discharges: DataFrame) -> DataFrame:
    codes = _numbered_codes(discharges, "icd10_group", "discharge_code", "discharge_type_id")
    return _described(codes, "discharge_code").select(
        "discharge_type_id",
        "discharge_code",
        F.col("_name").alias("discharge_name"),
        F.col("_category").alias("discharge_category"),
        F.col("discharge_code").alias("icd10_codes"),
        icd10_description(F.col("_name"), F.col("_category")).alias("discharge_description"),
        icd10_is_respiratory(F.col("discharge_code")).alias("is_respiratory"),
        F.lit(1).alias("is_active"),
    )


# --- facts ------------------------------------------------------------------------------------


def _lookup(fact: DataFrame, dim: DataFrame, code: str, natural: str, key: str) -> DataFrame:
    """Replace a natural code by the dimension key; rows without a match are dropped."""
    return fact.join(dim.select(F.col(code).alias(natural), key), natural, "inner").drop(natural)


def population_by_key(population: DataFrame, geography: DataFrame) -> DataFrame:
    """First population per region and year under the star's keys, unrounded."""
    rows = drop_null_codes(population, "geo", "year", "population")
    first = keep_first(rows, ["geo", "year"], "population")
    keyed = _lookup(first, geography, "nuts_id", "geo", "geography_id")
    return keyed.select("geography_id", F.col("year").alias("time_id"), "population")


def fact_population(population: DataFrame, geography: DataFrame) -> DataFrame:
    keyed = population_by_key(population, geography)
    return keyed.withColumn("population", F.col("population").cast("bigint"))


def fact_emissions(emissions: DataFrame, geography: DataFrame, sectors: DataFrame, gases: DataFrame) -> DataFrame:
    value = "emissions_kt_co2e"
    grain = ["nuts_id", "year", "sector", "gas"]
    first = keep_first(drop_null_codes(emissions, *grain, value), grain, value)
    keyed = _lookup(first, geography, "nuts_id", "nuts_id", "geography_id")
    keyed = _lookup(keyed, sectors, "sector_code", "sector", "sector_id")
    keyed = _lookup(keyed, gases, "gas_code", "gas", "gas_id")
    return keyed.select("geography_id", F.col("year").alias("time_id"), "sector_id", "gas_id", value)


def _health_rows(df: DataFrame, stratum: str, value: str) -> DataFrame:
    if stratum not in ("first", "standard"):
        raise ValueError(f"unknown stratum {stratum!r}")
    if stratum == "standard":
        df = standard_stratum(df, HEALTH_STRATUM)
    grain = ["nuts_id", "year", "icd10_group"]
    return keep_first(drop_null_codes(df, *grain, value), grain, value)


def fact_causes_of_death(
    causes: DataFrame, geography: DataFrame, icd10: DataFrame, stratum: str = "first"
) -> DataFrame:
    """Death rates per region, year and cause.

    The grain has no sex, age or unit. ``stratum="first"`` keeps the first source row of a grain
    whatever its stratum; ``"standard"`` keeps annual totals of all sexes and ages only.
    """
    value = "age_standardised_rate_per_100k"
    keyed = _lookup(_health_rows(causes, stratum, value), geography, "nuts_id", "nuts_id", "geography_id")
    keyed = _lookup(keyed, icd10, "icd10_code", "icd10_group", "icd10_cod_id")
    return keyed.select("geography_id", F.col("year").alias("time_id"), "icd10_cod_id", value)


def fact_hospital_discharges(
    discharges: DataFrame,
    geography: DataFrame,
    discharge_types: DataFrame,
    populations: DataFrame,
    stratum: str = "first",
) -> DataFrame:
    """Discharges per region, year and type with the rate per 100 000 inhabitants.

    ``populations`` has the unrounded population per key (``population_by_key``); without one the
    rate is NULL.
    """
    keyed = _lookup(_health_rows(discharges, stratum, "discharges"), geography, "nuts_id", "nuts_id", "geography_id")
    keyed = _lookup(keyed, discharge_types, "discharge_code", "icd10_group", "discharge_type_id")
    keyed = keyed.withColumnRenamed("year", "time_id")
    joined = keyed.join(populations.select("geography_id", "time_id", "population"), ["geography_id", "time_id"], "left")
    rate = per_100k(F.col("discharges"), F.col("population").cast("double"))
    return joined.select(
        "geography_id",
        "time_id",
        "discharge_type_id",
        F.col("discharges").alias("discharge_count"),
        round_half_even(rate, 2).alias("discharge_rate_per_100k"),
    )


# --- views ------------------------------------------------------------------------------------

_REGION = ["nuts_id", "nuts_label", "nuts_level", "country_iso", "country_name"]


def _with_region_and_year(fact: DataFrame, geography: DataFrame, times: DataFrame) -> DataFrame:
    return fact.join(geography.select("geography_id", *_REGION), "geography_id").join(
        times.select("time_id", "year", "decade"), "time_id"
    )


def vw_emissions(fact: DataFrame, geography: DataFrame, times: DataFrame, sectors: DataFrame, gases: DataFrame) -> DataFrame:
    joined = _with_region_and_year(fact, geography, times)
    joined = joined.join(sectors.select("sector_id", "sector_code", "sector_name", "sector_group"), "sector_id")
    joined = joined.join(gases.select("gas_id", "gas_code", "gas_name"), "gas_id")
    return joined.select(
        *_REGION, "year", "decade", "sector_code", "sector_name", "sector_group", "gas_code", "gas_name", "emissions_kt_co2e"
    )


def vw_health_metrics(fact: DataFrame, geography: DataFrame, times: DataFrame, icd10: DataFrame) -> DataFrame:
    causes = ["icd10_code", "icd10_name", "icd10_category", "is_respiratory"]
    joined = _with_region_and_year(fact, geography, times).join(icd10.select("icd10_cod_id", *causes), "icd10_cod_id")
    return joined.select(*_REGION, "year", "decade", *causes, "age_standardised_rate_per_100k")


def vw_hospital_discharges(fact: DataFrame, geography: DataFrame, times: DataFrame, discharge_types: DataFrame) -> DataFrame:
    types = ["discharge_code", "discharge_name", "discharge_category", "is_respiratory"]
    joined = _with_region_and_year(fact, geography, times).join(
        discharge_types.select("discharge_type_id", *types), "discharge_type_id"
    )
    return joined.select(*_REGION, "year", "decade", *types, "discharge_count", "discharge_rate_per_100k")

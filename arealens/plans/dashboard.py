"""Dashboard queries over the stored curated table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_avg, round_half_even, title_label
from ..operators import columns_like, rows_from_columns, slice_rows, top_and_bottom

def with_region_labels(curated: DataFrame) -> DataFrame:
    """Add the label (code where unnamed) and the display form ``code · label``."""
    label = F.coalesce("nuts_label", "nuts_id")
    return curated.withColumns(
        {"region_label": label, "region_display": F.concat("nuts_id", F.lit(" · "), label)}
    )


def dashboard_slice(
    curated: DataFrame,
    year: int | None = None,
    countries: Iterable[str] = (),
    regions: Iterable[str] = (),
) -> DataFrame:
    """Rows of one year (the last one by default), optionally of some countries and region codes.

    The default year is a scalar subquery: it is computed once and filters the scan.
    """
    wanted = F.lit(year) if year is not None else curated.agg(F.max("year")).scalar()
    rows = with_region_labels(curated).filter(F.col("year") == wanted)
    return slice_rows(rows, country_iso=list(countries), nuts_id=list(regions))


def top_and_bottom_regions(rows: DataFrame, metric: str, n: int = 8) -> DataFrame:
    """Regions with the highest and the lowest values of a health metric."""
    return top_and_bottom(rows.select("nuts_id", "region_label", "country_iso", metric), metric, n, ("nuts_id",))


def key_stats(rows: DataFrame, metrics: Iterable[str]) -> DataFrame:
    """Mean, minimum and maximum of the metrics, one row per statistic."""
    metrics = list(dict.fromkeys(metrics))
    functions = {"Mean": exact_avg, "Min": F.min, "Max": F.max}
    row = rows.agg(
        *[
            F.struct(*[round_half_even(f(F.col(m)), 2).alias(m) for m in metrics]).alias(stat)
            for stat, f in functions.items()
        ]
    )
    return row.unpivot([], list(functions), "stat", "s").select("stat", "s.*")


def comparison(rows: DataFrame, map_metric: str, health_metric: str) -> DataFrame:
    """Comparison table, highest map metric first."""
    columns = dict.fromkeys(
        ["region_label", "country_iso", "total_emissions_kt", "emissions_per_capita_tonnes", map_metric, health_metric]
    )
    ordered = rows.orderBy(F.col(map_metric).desc_nulls_last(), "nuts_id")
    return ordered.select(*columns)


def sector_breakdown(rows: DataFrame) -> DataFrame:
    """Emissions per region and sector group with display names."""
    ids = ["region_label", "nuts_id", "country_iso", "total_emissions_kt"]
    sectors = columns_like(rows, "emissions_", "_kt")
    long = rows_from_columns(rows, ids, sectors, "sector_group", "emissions_kt")
    return long.withColumn("sector_group", title_label(F.col("sector_group"), ("emissions_", "_kt")))


def region_options(curated: DataFrame) -> DataFrame:
    """Display label -> region code, one row per label, in label order."""
    return (
        with_region_labels(curated)
        .select("region_display", "nuts_id")
        .distinct()
        .groupBy("region_display")
        .agg(F.max("nuts_id").alias("nuts_id"))
        .orderBy("region_display")
    )


def year_range(curated: DataFrame) -> DataFrame:
    """Bounds of the year selector."""
    return curated.agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))


def country_options(curated: DataFrame) -> DataFrame:
    return curated.select("country_iso").distinct().orderBy("country_iso")


def region_map(rows: DataFrame, features: DataFrame, metric: str, level: int = 2) -> DataFrame:
    """Region shapes of one level with the metric of their region, for a map."""
    shapes = region_features(features, level)
    return shapes.join(rows.select("nuts_id", "region_label", "country_iso", metric), "nuts_id", "inner")


def region_features(features: DataFrame, level: int = 2) -> DataFrame:
    """Features of one level, keyed by region code."""
    return features.filter(F.col("properties")["LEVL_CODE"].try_cast("int") == level).select(
        F.col("properties")["NUTS_ID"].alias("nuts_id"), "properties", "geometry"
    )

"""Integrity checks over the star schema; each returns a small report table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import level_name
from ..schemas import DIMENSIONS, FACT_GRAINS, FACTS, FOREIGN_KEYS, REQUIRED_COLUMNS
from .warehouse import Star

# Longest text accepted by the relational layout, by dimension column.
TEXT_LIMITS = {"dim_geography": {"nuts_id": 10, "country_iso": 3}}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def table_counts(star: Star) -> DataFrame:
    """Rows per table; on stored tables Spark answers from the Parquet footers."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name, df in star.tables().items()
        ]
    )


def level_counts(star: Star) -> DataFrame:
    """Regions per level."""
    return (
        star.dim_geography.groupBy("nuts_level")
        .agg(F.count(F.lit(1)).alias("n_regions"))
        .select("nuts_level", level_name(F.col("nuts_level")).alias("level_name"), "n_regions")
        .orderBy("nuts_level")
    )


def year_range(star: Star) -> DataFrame:
    return star.dim_time.agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))


def orphans(star: Star) -> DataFrame:
    """Fact rows without a dimension row, per fact and foreign key.

    Each fact is read once: counted per combination of its keys, which then look up all dimensions.
    """
    tables = star.tables()
    parts = []
    for fact in FACTS:
        keys = [key for key in FOREIGN_KEYS if key in tables[fact].columns]
        counted = tables[fact].groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        for key in keys:
            known = tables[FOREIGN_KEYS[key]].select(key).distinct().withColumn(f"_{key}", F.lit(True))
            counted = counted.join(known, key, "left")
        missing = [F.sum(F.when(F.col(f"_{key}").isNull(), F.col("_n")).otherwise(0)) for key in keys]
        row = counted.agg(*[F.coalesce(n, F.lit(0)).alias(key) for n, key in zip(missing, keys)])
        parts.append(row.unpivot([], keys, "key_name", "n_orphans").withColumn("fact_name", F.lit(fact)))
    return _union(parts).select("fact_name", "key_name", "n_orphans")


def grain_duplicates(star: Star) -> DataFrame:
    """Rows, distinct grains and surplus rows per fact."""
    tables = star.tables()
    parts = []
    for fact, grain in FACT_GRAINS.items():
        per_grain = tables[fact].groupBy(*grain).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            per_grain.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_grains")
            ).select(
                F.lit(fact).alias("fact_name"),
                "n_rows",
                "n_grains",
                (F.col("n_rows") - F.col("n_grains")).alias("n_surplus"),
            )
        )
    return _union(parts)


def missing_required(star: Star) -> DataFrame:
    """NULLs in required columns, one scan per table."""
    tables = star.tables()
    parts = []
    for name in (*DIMENSIONS, *FACTS):
        columns = [*FACT_GRAINS.get(name, ()), *REQUIRED_COLUMNS[name]]
        stats = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        parts.append(
            stats.unpivot([], columns, "column_name", "n_missing").select(
                F.lit(name).alias("table_name"), "column_name", "n_missing"
            )
        )
    return _union(parts)


def too_long(star: Star) -> DataFrame:
    """Values longer than the relational layout accepts."""
    tables = star.tables()
    parts = []
    for name, limits in TEXT_LIMITS.items():
        stats = tables[name].agg(*[F.count_if(F.length(c) > limit).alias(c) for c, limit in limits.items()])
        parts.append(
            stats.unpivot([], list(limits), "column_name", "n_too_long").select(
                F.lit(name).alias("table_name"), "column_name", "n_too_long"
            )
        )
    return _union(parts)

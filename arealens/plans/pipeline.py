"""The whole route from raw files to stored products.

``ingest`` stores the tidy tables, ``build_curated`` and ``build_star`` read those and store their
product. The steps only share folders, so they can run as separate applications.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources import read_sheets, read_table, read_wide_tsv, write_table
from . import tidy
from .curated import curated
from .star import Tidy
from .warehouse import Star, load_star

TIDY_TABLES = ("emissions", "causes", "discharges", "population")


def ingest(
    spark: SparkSession,
    root: str,
    emission_sheets: Mapping[str, str],
    causes: str,
    discharges: str,
    population: str,
    level_only: int | None = None,
) -> Tidy:
    """Tidy the four raw sources and store them under ``root``.

    ``emission_sheets`` maps sheet names to exported sheet files; the others are wide text tables.
    Rows keep their source position, which decides what "the first row" is later on.
    """
    tables = {
        "emissions": tidy.emissions(read_sheets(spark, emission_sheets), level_only=level_only),
        "causes": tidy.causes_of_death(read_wide_tsv(spark, causes), level_only),
        "discharges": tidy.hospital_discharges(read_wide_tsv(spark, discharges), level_only),
        "population": tidy.population_wide(read_wide_tsv(spark, population), level_only),
    }
    for name, df in tables.items():
        write_table(df, f"{root}/{name}")
    return read_tidy(spark, root)


def read_tidy(spark: SparkSession, root: str) -> Tidy:
    """The stored tidy tables."""
    return Tidy(*[read_table(spark, f"{root}/{name}") for name in TIDY_TABLES])


def build_curated(
    spark: SparkSession,
    root: str,
    path: str,
    level_only: int | None = 2,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Build the curated table from the tidy tables under ``root`` and store it."""
    t = read_tidy(spark, root)
    write_table(curated(t.emissions, t.causes, t.discharges, t.population, level_only, years), path)
    return read_table(spark, path)


def build_star(spark: SparkSession, root: str, path: str, **options) -> Star:
    """Load the star schema from the tidy tables under ``root``; options as in ``load_star``."""
    return load_star(spark, read_tidy(spark, root), path, **options)

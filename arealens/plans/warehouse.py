"""Loading the star schema into stored tables, and reading it back."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..schemas import DIMENSIONS, FACTS
from ..sources.stored import Versions, read_table, write_table
from . import star
from .star import Tidy

# Tables of a step only need tables of earlier steps.
LOAD_STEPS = (
    ("dim_geography", "dim_sector", "dim_gas", "dim_icd10_cod", "dim_discharge_type"),
    ("fact_population", "fact_emissions", "fact_causes_of_death"),
    ("fact_hospital_discharges", "dim_time"),
)
VIEWS = ("vw_emissions", "vw_health_metrics", "vw_hospital_discharges")


def _unstored(name: str, build: Callable[[], DataFrame]) -> DataFrame:
    return build()


class Star:
    """Dimensions, facts and views of the star schema, each defined on first use.

    ``keep(name, build)`` decides what becomes of a table: left lazy (the default), stored and read
    back (``load_star``), or read from an earlier load (``read_star``). Facts build on the kept
    dimensions, so a stored star computes no table twice.
    """

    def __init__(
        self,
        tidy: Tidy | None,
        level_only: int | None = None,
        stratum: str = "first",
        keep: Callable[[str, Callable[[], DataFrame]], DataFrame] = _unstored,
    ):
        self._tidy = tidy
        self._level = level_only
        self._stratum = stratum
        self._keep = keep

    @property
    def _rows(self) -> Tidy:
        return self._tidy.at_level(self._level)

    @cached_property
    def dim_geography(self) -> DataFrame:
        return self._keep("dim_geography", lambda: star.dim_geography(self._tidy.emissions, self._level))

    @cached_property
    def dim_time(self) -> DataFrame:
        return self._keep(
            "dim_time",
            lambda: star.with_availability(
                star.dim_time(self._tidy), self.fact_emissions, self.fact_causes_of_death, self.fact_population
            ),
        )

    @cached_property
    def dim_sector(self) -> DataFrame:
        return self._keep("dim_sector", lambda: star.dim_sector(self._tidy.emissions))

    @cached_property
    def dim_gas(self) -> DataFrame:
        return self._keep("dim_gas", lambda: star.dim_gas(self._tidy.emissions))

    @cached_property
    def dim_icd10_cod(self) -> DataFrame:
        return self._keep("dim_icd10_cod", lambda: star.dim_icd10_cod(self._tidy.causes))

    @cached_property
    def dim_discharge_type(self) -> DataFrame:
        return self._keep("dim_discharge_type", lambda: star.dim_discharge_type(self._tidy.discharges))

    @cached_property
    def fact_population(self) -> DataFrame:
        return self._keep(
            "fact_population", lambda: star.fact_population(self._rows.population, self.dim_geography)
        )

    @cached_property
    def fact_emissions(self) -> DataFrame:
        return self._keep(
            "fact_emissions",
            lambda: star.fact_emissions(self._rows.emissions, self.dim_geography, self.dim_sector, self.dim_gas),
        )

    @cached_property
    def fact_causes_of_death(self) -> DataFrame:
        return self._keep(
            "fact_causes_of_death",
            lambda: star.fact_causes_of_death(
                self._rows.causes, self.dim_geography, self.dim_icd10_cod, self._stratum
            ),
        )

    @cached_property
    def fact_hospital_discharges(self) -> DataFrame:
        return self._keep(
            "fact_hospital_discharges",
            lambda: star.fact_hospital_discharges(
                self._rows.discharges,
                self.dim_geography,
                self.dim_discharge_type,
                star.population_by_key(self._rows.population, self.dim_geography),
                self._stratum,
            ),
        )

    @property
    def vw_emissions(self) -> DataFrame:
        return star.vw_emissions(
            self.fact_emissions, self.dim_geography, self.dim_time, self.dim_sector, self.dim_gas
        )

    @property
    def vw_health_metrics(self) -> DataFrame:
        return star.vw_health_metrics(
            self.fact_causes_of_death, self.dim_geography, self.dim_time, self.dim_icd10_cod
        )

    @property
    def vw_hospital_discharges(self) -> DataFrame:
        return star.vw_hospital_discharges(
            self.fact_hospital_discharges, self.dim_geography, self.dim_time, self.dim_discharge_type
        )

    def tables(self) -> dict[str, DataFrame]:
        """All dimensions, then all facts."""
        return {name: getattr(self, name) for name in (*DIMENSIONS, *FACTS)}

    def load(self) -> Star:
        """Have every table kept now. The tables of a step are loaded side by side."""
        with ThreadPoolExecutor(max_workers=5) as pool:
            for step in LOAD_STEPS:
                list(pool.map(lambda name: getattr(self, name), step))
        return self

    def create_views(self) -> None:
        """Register all tables and the joined views for ``spark.sql``."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)
        for name in VIEWS:
            getattr(self, name).createOrReplaceTempView(name)


def load_star(
    spark: SparkSession,
    tidy: Tidy,
    root: str,
    level_only: int | None = None,
    stratum: str = "first",
    stamp: bool = True,
    by_year: bool = False,
) -> Star:
    """Full refresh of all star tables under ``root``, as one ``Versions`` commit.

    Whole tables are replaced, so a load can be repeated; readers see the new star only once all of
    its tables are written, and a load that fails leaves the whole earlier star. Each table is read back from its files:
    later joins then know its size, and a lost executor costs a re-read, not a recomputation.
    ``by_year`` lays the facts out in one folder per year, for facts large enough to fill them; year
    filters then skip whole folders.
    """

    versions = Versions(spark, root)
    version = versions.begin()

    def store(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = versions.path(version, name)
        write_table(build(), path, stamp, partition_by=("time_id",) if by_year and name in FACTS else ())
        return read_table(spark, path)

    star = Star(tidy, level_only, stratum, keep=store).load()
    versions.commit(version)
    return star


def read_star(spark: SparkSession, root: str) -> Star:
    """The last whole star stored under ``root``, for query sessions."""
    versions = Versions(spark, root)
    return Star(None, keep=lambda name, build: versions.read(name))

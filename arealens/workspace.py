"""Session workspace: tables derived from a data folder, built once and shared by the queries.

Emission, cause, discharge, population, curated and star tables are kept when a query first needs
them, so the large sources are scanned and joined once per session instead of once per query or per
reference in a plan. With a folder in ``spark.checkpoint.dir`` they are written there and read back:
later joins know the real table sizes, and lost executors re-read files. Without one they are
persisted. Causes and discharges are as long as their sources, so keeping them costs one copy; every
fact, dimension, profile and set query that reads them then starts from that copy.

The stored copy has a fixed name per application, ``arealens-<application id>-<folder>``, and goes
when the session ends; after a killed driver the folder of that name can be deleted.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from .bindings import Sources
from .plans.curated import curated
from .plans.star import Tidy
from .plans.warehouse import Star
from .sources.stored import read_table, write_table


class Workspace:
    def __init__(self, spark: SparkSession, folder: str, version: int = 0):
        self.spark = spark
        self.sources = Sources(spark, folder)
        shared = spark.conf.get("spark.checkpoint.dir", None)
        name = f"arealens-{spark.sparkContext.applicationId}-{zlib.crc32(folder.encode()):08x}-{version}"
        self._root = shared and f"{shared.rstrip('/')}/{name}"
        self._files = f"{(shared or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{name}-files"
        self._persisted: list[DataFrame] = []
        if self._root:
            self._folder(self._root)

    def _folder(self, root: str) -> None:
        """A folder that goes when the session ends."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)

    def _keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if self._root:
            path = f"{self._root}/{name}"
            write_table(build(), path)
            return read_table(self.spark, path)
        kept = build().persist(StorageLevel.MEMORY_AND_DISK)
        self._persisted.append(kept)
        return kept

    def scratch(self, name: str) -> str:
        """Path of a file that a query writes to read it back; it goes when the session ends."""
        self._folder(self._files)
        return f"{self._files}/{name}"

    def release(self) -> None:
        """Give back what was persisted."""
        for df in self._persisted:
            df.unpersist()

    @cached_property
    def emissions(self) -> DataFrame:
        return self._keep("emissions", lambda: self.sources.emissions)

    @cached_property
    def causes(self) -> DataFrame:
        return self._keep("causes", lambda: self.sources.causes)

    @cached_property
    def discharges(self) -> DataFrame:
        return self._keep("discharges", lambda: self.sources.discharges)

    @cached_property
    def population(self) -> DataFrame:
        return self._keep("population", lambda: self.sources.population)

    @cached_property
    def tidy(self) -> Tidy:
        return Tidy(self.emissions, self.causes, self.discharges, self.population)

    @cached_property
    def curated(self) -> DataFrame:
        tidy = self.tidy
        return self._keep(
            "curated", lambda: curated(tidy.emissions, tidy.causes, tidy.discharges, tidy.population)
        )

    @cached_property
    def star(self) -> Star:
        return Star(self.tidy, keep=self._keep)


_open: dict[tuple[str, str], Workspace] = {}
_versions: dict[tuple[str, str], int] = {}


def workspace(spark: SparkSession, folder: str, refresh: bool = False) -> Workspace:
    """The workspace of a data folder in this Spark application; ``refresh`` begins it anew.

    Tables that were kept before a change of the folder's files are not renewed by themselves.
    """
    key = (spark.sparkContext.applicationId, folder)
    old = _open.get(key)
    if old is None or refresh:
        if old:
            old.release()
        _versions[key] = _versions.get(key, -1) + 1
        _open[key] = Workspace(spark, folder, _versions[key])
    return _open[key]

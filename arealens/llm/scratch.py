"""Tables that an operator writes once and reads several times.

They go to the shared folder that ``spark.checkpoint.dir`` names; where it is unset, to the session's
warehouse. A lost executor re-reads files instead of recomputing their lineage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def small_batches(spark: SparkSession) -> None:
    """Rows have whole texts or sets: small batches bound what a Python worker holds at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


class Scratch:
    """A folder of one operator run. It goes when the session ends, its large tables by ``drop``."""

    def __init__(self, spark: SparkSession, name: str):
        self._spark = spark
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        self._root = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        path = self._path("")
        self._files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._files.mkdirs(path)
        self._files.deleteOnExit(path)

    def _path(self, name: str):
        return self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}" if name else self._root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self._root}/{name}")
        return self._spark.read.schema(df.schema).parquet(f"{self._root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            self._files.delete(self._path(name), True)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; others, whatever their names, stay out of the operator's way."""
    return df.select(*[df[n] for n in names])

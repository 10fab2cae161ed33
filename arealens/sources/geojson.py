"""Region features from GeoJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Properties are kept whole, whatever their names; coordinates stay JSON text: they are passed
# through, never computed on.
FIELDS = ("type: string", "id: string", "properties: map<string, string>", "geometry: struct<type: string, coordinates: string>")
FEATURE = f"struct<{', '.join(FIELDS)}>"


def read_features(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """Feature rows ``(type, id, properties, geometry)``.

    A feature collection is one JSON document per file, so one task reads a file. Large region sets
    come as newline-delimited features (``lines=True``), which Spark splits.
    """
    if lines:
        return spark.read.schema(", ".join(field.replace(": ", " ", 1) for field in FIELDS)).json(path)
    return explode_features(spark.read.schema(f"type string, features array<{FEATURE}>").json(path, multiLine=True))


def explode_features(collections: DataFrame) -> DataFrame:
    """One row per feature of ``features`` arrays."""
    return collections.select(F.explode("features").alias("feature")).select("feature.*")

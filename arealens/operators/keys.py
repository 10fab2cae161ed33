"""Keep-first de-duplication and dense surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import SOURCE_ORDER


def first_value(df: DataFrame, column: str, order: str | None = SOURCE_ORDER) -> Column:
    """Aggregate: the value of the first row, or the least value where the table has no order."""
    if order and order in df.columns:
        return F.min_by(column, order)
    return F.min(column)


def keep_first(df: DataFrame, grain: list[str], measure: str, order: str | None = SOURCE_ORDER) -> DataFrame:
    """One row per grain with the measure of its first row.

    An aggregate instead of a ``row_number`` window: it combines on the map side, so a grain that
    repeats a billion times reaches the shuffle as one row per task.
    """
    return df.groupBy(*grain).agg(first_value(df, measure, order).alias(measure))


def dense_ids(df: DataFrame, code: str, id_column: str, prefix_length: int = 2) -> DataFrame:
    """Number distinct codes 1..n in code order without sorting them in one task.

    Codes are numbered inside their prefix, and each prefix starts after the codes of all smaller
    prefixes. Only one row per prefix goes through the single-task running sum. The codes are
    referenced twice (a prefix meets in one task: choose its length so that a prefix has few codes, as
    they are the keys of a dimension); both references need the same rows and columns of the distinct step before,
    so Spark runs that step, and the scan under it, once.
    """
    prefix = "_prefix"
    keyed = df.filter(F.col(code).isNotNull()).withColumn(prefix, F.substring(code, 1, prefix_length))
    keyed = keyed.filter(F.col(prefix).isNotNull())
    before = Window.orderBy(prefix).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(prefix)
        .agg(F.count(F.lit(1)).alias("_codes"))
        .select(prefix, F.coalesce(F.sum("_codes").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy(prefix).orderBy(code))
    return (
        keyed.withColumn("_inside", inside)
        .join(offsets, prefix)
        .select((F.col("_offset") + F.col("_inside")).cast("int").alias(id_column), *df.columns)
    )

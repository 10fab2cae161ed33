"""Top-n selections. Ordered limits run as a per-task heap plus one small merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _ordered(df: DataFrame, by: str, ties: tuple[str, ...], descending: bool) -> DataFrame:
    key = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.orderBy(key, *[F.col(t).asc_nulls_last() for t in ties])


def top_n(df: DataFrame, by: str, n: int, ties: tuple[str, ...], descending: bool = True) -> DataFrame:
    """The ``n`` first rows by a measure, missing values last, ties by the given columns."""
    return _ordered(df, by, ties, descending).limit(n)


def preview(df: DataFrame, *order: str, n: int = 5) -> DataFrame:
    """The first rows of a table in a stated order."""
    return df.orderBy(*order).limit(n)


def top_and_bottom(df: DataFrame, by: str, n: int, ties: tuple[str, ...]) -> DataFrame:
    """The ``n`` highest and the ``n`` lowest rows; a small table may show a row in both."""
    return top_n(df, by, n, ties).unionAll(top_n(df, by, n, ties, descending=False))


def first_per_group(df: DataFrame, groups: list[Column | str], order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each group. Spark limits per task before it shuffles the groups."""
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")

"""Union, intersection and overlap of value sets from several sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def membership(sets: Mapping[str, DataFrame], column: str) -> DataFrame:
    """One row per distinct value with a 0/1 flag per source.

    All unions, intersections and pairwise overlaps follow from these flags, so the sources are
    read and shuffled once instead of once per set operation. Each source is reduced to its
    distinct values before the union.
    """
    names = list(sets)
    parts = [
        df.select(F.col(column).alias("value"))
        .filter("value IS NOT NULL")
        .distinct()
        .select("value", *[F.lit(int(other == name)).alias(other) for other in names])
        for name, df in sets.items()
    ]
    union = reduce(DataFrame.unionByName, parts)
    return union.groupBy("value").agg(*[F.max(name).alias(name) for name in names])


def overlap_summary(sets: Mapping[str, DataFrame], column: str) -> DataFrame:
    """``(measure, first, last, n)`` for each source, each pair, the union and the intersection."""
    names = list(sets)
    flags = membership(sets, column)
    tests = {name: F.col(name) == 1 for name in names}
    tests |= {
        f"{a} & {b}": (F.col(a) == 1) & (F.col(b) == 1) for a, b in combinations(names, 2)
    }
    tests["union"] = F.lit(True)
    tests["intersection"] = reduce(lambda x, y: x & y, [F.col(n) == 1 for n in names])
    stats = flags.agg(
        *[
            F.struct(
                F.min(F.when(test, F.col("value"))).alias("first"),
                F.max(F.when(test, F.col("value"))).alias("last"),
                F.count(F.when(test, F.lit(1))).alias("n"),
            ).alias(measure)
            for measure, test in tests.items()
        ]
    )
    return stats.unpivot([], list(tests), "measure", "s").select("measure", "s.first", "s.last", "s.n")

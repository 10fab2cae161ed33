"""Greenhouse gas attributes from free-form gas codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, tested in this order: (parts looked for in the upper-case code, name, formula,
# 100-year warming potential).
GAS_FAMILIES = (
    (("CH4", "METHANE"), "Methane", "CH₄", 28.0),
    (("N2O", "NITROUS"), "Nitrous Oxide", "N₂O", 265.0),
    (("F-GAS", "F_GAS", "FLUORINATED"), "Fluorinated Gases", "F-gases", 1000.0),
    (("CO2", "CARBON"), "Carbon Dioxide", "CO₂", 1.0),
)


def gas_info(code: Column) -> Column:
    """Struct ``(gas_name, gas_formula, gwp_ar5)``; unknown codes keep the code as their name."""
    upper = F.upper(code)

    def info(name: Column, formula: Column, gwp: Column) -> Column:
        return F.struct(
            name.cast("string").alias("gas_name"),
            formula.cast("string").alias("gas_formula"),
            gwp.cast("double").alias("gwp_ar5"),
        )

    unknown = info(code, F.lit(None), F.lit(None))
    # Folded from the last family to the first so that the first match ends up outermost.
    return reduce(
        lambda rest, family: F.when(
            reduce(lambda a, b: a | b, [upper.contains(part) for part in family[0]]),
            info(F.lit(family[1]), F.lit(family[2]), F.lit(family[3])),
        ).otherwise(rest),
        reversed(GAS_FAMILIES),
        unknown,
    )

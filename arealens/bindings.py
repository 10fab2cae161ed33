"""The statistics sources, derived from the order-and-event tables of a data folder.

Customers stand for regions (a code of two to five characters), line items for emission records,
orders for death rates, events for discharges. The same derivation is written in SQL in
``sql_oracles.py``; the two are compared row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans.star import Tidy
from .schemas import SOURCE_ORDER

RAW_CAUSES_HEADER = "freq,unit,sex,age,icd10,geo\\TIME_PERIOD"
RAW_DISCHARGES_HEADER = "freq,age,indic_he,unit,sex,icd10,geo\\TIME_PERIOD"
RAW_POPULATION_HEADER = "freq,unit,sex,age,geo\\TIME_PERIOD"

# Gases and sectors in the order of their numbers in the emission derivation.
_GASES = ("GWP_100_AR5_CH4", "CO2", "GWP_100_AR5_N2O")
_SECTORS = (
    ("Agriculture", "agriculture"),
    ("Buildings", "buildings"),
    ("Energy", "energy"),
    ("Transport", "transport"),
    ("Dom_Avi", "transport"),
    ("Unlisted", "other"),
)
_SECTOR_OF_TYPE = {"ECONOMY": 0, "SMALL": 1, "MEDIUM": 2, "PROMO": 3, "STANDARD": 4}


def _case(column: str | Column, values: dict, default) -> Column:
    subject = F.col(column) if isinstance(column, str) else column
    pairs = list(values.items())
    expr = F.when(subject == pairs[0][0], pairs[0][1])
    for key, value in pairs[1:]:
        expr = expr.when(subject == key, value)
    return expr.otherwise(default)


class Sources:
    """Lazy tidy and raw sources over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def regions(self) -> DataFrame:
        """Customer -> region code and nation."""

        def digit(divisor: int, base: int) -> Column:
            return F.expr(f"cast(c_custkey div {divisor} % {base} as string)")

        code = F.concat(
            F.char(65 + F.col("n_regionkey")), F.char(65 + F.col("n_nationkey")), digit(1, 3), digit(3, 3), digit(9, 4)
        )
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                "c_custkey",
                "n_nationkey",
                F.substring(code, F.lit(1), (2 + F.col("c_custkey") % 4).cast("int")).alias("nuts_id"),
            )
        )

    @cached_property
    def emissions(self) -> DataFrame:
        """Line items added up by region, year, gas and sector.

        What is shuffled per line item is kept small: gas and sector travel as numbers, the country
        as its key, and their names are attached to the added-up rows.
        """
        lines = self.table("lineitem").select(
            "l_orderkey",
            "l_partkey",
            F.col("l_extendedprice").cast("decimal(18,2)").alias("_kt"),
            F.year("l_shipdate").alias("year"),
            _case("l_returnflag", {"R": 0, "A": 1}, 2).alias("_gas"),
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        parts = self.table("part").select("p_partkey", _case("p_type", _SECTOR_OF_TYPE, 5).alias("_sector"))
        places = self.regions.select("c_custkey", "nuts_id", "n_nationkey")
        located = orders.join(places, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey", "nuts_id", "n_nationkey"
        )
        # Line items and orders both grow with the data, so neither is broadcast even while small.
        totals = (
            lines.join(located.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("nuts_id", "n_nationkey", "year", "_gas", "_sector")
            .agg(F.sum("_kt").cast("double").alias("emissions_kt_co2e"))
        )
        sector = F.col("_sector")
        names = self.table("nation").select("n_nationkey", F.col("n_name").alias("country_name"))
        return totals.join(names, "n_nationkey").select(
            "nuts_id",
            F.when(F.length("nuts_id") > 2, F.concat(F.lit("Region "), F.col("nuts_id"))).alias("nuts_label"),
            F.substring("nuts_id", 1, 2).alias("country_iso"),
            "country_name",
            "year",
            _case("_gas", dict(enumerate(_GASES[:-1])), _GASES[-1]).alias("gas"),
            _case(sector, {i: name for i, (name, _) in enumerate(_SECTORS[:-1])}, _SECTORS[-1][0]).alias("sector"),
            _case(sector, {i: group for i, (_, group) in enumerate(_SECTORS[:-1])}, _SECTORS[-1][1]).alias(
                "sector_group"
            ),
            "emissions_kt_co2e",
        )

    @cached_property
    def causes(self) -> DataFrame:
        places = self.regions.select("c_custkey", "nuts_id")
        priority = F.substring("o_orderpriority", 1, 1)
        codes = {"1": "J", "2": "J12-J18", "3": "J40-J44_J47", "4": "I20-I25"}
        return (
            self.table("orders")
            .join(places, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_orderkey").alias(SOURCE_ORDER),
                "nuts_id",
                F.year("o_orderdate").alias("year"),
                F.lit("A").alias("frequency"),
                F.lit("RT").alias("unit_code"),
                _case("o_orderstatus", {"F": "F", "O": "T"}, "M").alias("sex"),
                F.when(F.col("o_orderkey") % 5 == 0, "Y_GE65").otherwise("TOTAL").alias("age_group"),
                _case(priority, codes, "C00-D48").alias("icd10_group"),
                F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("age_standardised_rate_per_100k"),
            )
        )

    @cached_property
    def discharges(self) -> DataFrame:
        places = self.regions.select("c_custkey", "nuts_id")
        codes = {"view": "J", "click": "J00-J11", "error": "J20-J22", "purchase": "J45_J46"}
        return (
            self.table("events")
            .join(places, F.col("user_id") == F.col("c_custkey"))
            .select(
                F.col("event_id").alias(SOURCE_ORDER),
                "nuts_id",
                (1995 + F.col("event_id") % 7).cast("int").alias("year"),
                F.lit("A").alias("frequency"),
                F.lit("INPAT").alias("indicator"),
                F.lit("NR").alias("unit_code"),
                _case(F.col("event_id") % 3, {0: "T", 1: "F"}, "M").alias("sex"),
                F.lit("TOTAL").alias("age_group"),
                _case("event_type", codes, "A-T_Z").alias("icd10_group"),
                F.floor("value").cast("double").alias("discharges"),
            )
        )

    @cached_property
    def population(self) -> DataFrame:
        """Every region in every order year.

        Customers are added up per region once; the few order years are then exploded per region.
        """
        years = (
            self.table("orders")
            .select(F.year("o_orderdate").alias("y"))
            .distinct()
            .agg(F.array_sort(F.collect_list("y")))
            .scalar()
        )
        people = self.regions.groupBy("nuts_id", "n_nationkey").agg(F.sum(1000 + F.col("c_custkey")).alias("_people"))
        return (
            people.withColumn("year", F.explode(years))
            .groupBy(F.col("nuts_id").alias("geo"), "year")
            .agg(F.sum("_people").cast("double").alias("population"))
        )

    @property
    def tidy(self) -> Tidy:
        return Tidy(self.emissions, self.causes, self.discharges, self.population)

    @cached_property
    def features(self) -> DataFrame:
        """Feature collections of one feature per region code, as read from GeoJSON."""
        code = F.col("nuts_id")
        return (
            self.regions.select("nuts_id")
            .distinct()
            .select(
                F.lit("FeatureCollection").alias("type"),
                F.array(
                    F.struct(
                        F.lit("Feature").alias("type"),
                        F.create_map(
                            F.lit("LEVL_CODE"), (F.length(code) - 2).cast("string"), F.lit("NUTS_ID"), code
                        ).alias("properties"),
                        F.struct(F.lit("Point").alias("type"), F.lit("[0,0]").alias("coordinates")).alias("geometry"),
                    )
                ).alias("features"),
            )
        )


# --- codes that reach every naming rule, spread over a key ----------------------------------------------

# At least one code for each rule, and codes that no rule knows.
RULE_CODES = (
    "A-R_V-Y A-T_Z a-t_z A-T_Z_XNB J J_OTH J09-J11 J00-J11 J12-J18 J12-J18_OTH J20-J22 J40-J44 J40-J44_J47 J45_J46 J60-J99"
    " A00-A08 A09 A15-A19_B90 A40_A41 B15-B19 B20-B24 A B C C_OTH C00-D48 D05 D50-D89 E10-E14 F00-F99 G20 H25-H26 H60-H95 H5 H"
    " H96 I I20-I25 I20-I25_OTH I60-I69_OTH I30 K70 L M N O P Q R S T V X60 Y Z38 U UPRESPIR_OTH 1"
).split()
RULE_GASES = "CO2 carbon GWP_100_AR5_CH4 methane N2O nitrous F-GAS f_gas GWP_100_AR5_F-gases fluorinated SF6 xyz".split()


def rule_codes(keys: DataFrame, key: str, codes: Sequence[str]) -> DataFrame:
    """(code, n_rows): the codes dealt to the rows by their key."""
    code = F.get(F.array(*[F.lit(c) for c in codes]), (F.col(key) % len(codes)).cast("int"))
    return keys.groupBy(code.alias("code")).agg(F.count("*").alias("n_rows"))


# --- raw layouts spread back from tidy rows, to run the ingest plans on ----------------------------


def years_of(df: DataFrame) -> list[int]:
    """The years that occur, which become columns."""
    return sorted(row[0] for row in df.select("year").dropna().distinct().collect())


def _numbered(df: DataFrame) -> Column:
    """The unit with the number of the source row, so that no two rows share a cell."""
    return F.concat_ws("_", "unit_code", SOURCE_ORDER)


def raw_causes(causes: DataFrame) -> DataFrame:
    """Wide causes of death: ``: `` where missing, flag ``b`` on female 1999 cells."""
    dims = ["frequency", _numbered(causes), "sex", "age_group", "icd10_group", "nuts_id"]
    text = F.col("age_standardised_rate_per_100k").cast("decimal(18,2)").cast("string")

    def cell(year: int) -> Column:
        flag = F.when((F.col("sex") == "F") & (F.col("year") == 1999), " b").otherwise(" ")
        return F.coalesce(F.when(F.col("year") == year, F.concat(text, flag)), F.lit(": ")).alias(f"{year} ")

    return causes.select(F.concat_ws(",", *dims).alias(RAW_CAUSES_HEADER), *[cell(y) for y in years_of(causes)])


def raw_discharges(discharges: DataFrame) -> DataFrame:
    """Wide discharges; region codes arrive in lower case with a trailing blank."""
    dims = ["frequency", "age_group", "indicator", _numbered(discharges), "sex", "icd10_group"]
    text = F.concat(F.col("discharges").cast("bigint").cast("string"), F.lit(" "))

    def cell(year: int) -> Column:
        return F.coalesce(F.when(F.col("year") == year, text), F.lit(": ")).alias(f"{year} ")

    key = F.concat_ws(",", *dims, F.concat(F.lower("nuts_id"), F.lit(" ")))
    return discharges.select(key.alias(RAW_DISCHARGES_HEADER), *[cell(y) for y in years_of(discharges)])


def _population_by_region(population: DataFrame, years: list[int]) -> DataFrame:
    return population.groupBy("geo").agg(
        *[F.max(F.when(F.col("year") == y, F.col("population"))).cast("bigint").alias(str(y)) for y in years]
    )


def raw_population(population: DataFrame) -> DataFrame:
    """Wide population with a total row and a female row per region."""
    years = years_of(population)
    rows = _population_by_region(population, years).withColumn("sex", F.explode(F.array(F.lit("T"), F.lit("F"))))
    key = F.concat(F.lit("A,NR,"), F.col("sex"), F.lit(",TOTAL,"), F.col("geo"))
    cells = [
        F.coalesce(F.concat(F.col(str(y)).cast("string"), F.lit(" ")), F.lit(": ")).alias(f"{y} ") for y in years
    ]
    return rows.select(key.alias(RAW_POPULATION_HEADER), *cells)


def raw_population_long(population: DataFrame) -> DataFrame:
    """The long interface layout, with a female row beside every total."""
    return population.withColumn("sex", F.explode(F.array(F.lit("T"), F.lit("F")))).select(
        F.lit("A").alias("freq"),
        F.lit("NR").alias("unit"),
        "sex",
        F.lit("TOTAL").alias("age"),
        F.lower("geo").alias("geo"),
        F.col("year").cast("string").alias("TIME_PERIOD"),
        F.col("population").cast("bigint").cast("string").alias("OBS_VALUE"),
    )


def raw_population_flagged(population: DataFrame) -> DataFrame:
    """The layout with a value and a flag column per year."""
    years = years_of(population)
    cells = [
        c
        for y in years
        for c in (F.col(str(y)).cast("double").alias(f"{y}_value"), F.lit("p").alias(f"{y}_flag"))
    ]
    return _population_by_region(population, years).select(
        F.lit("A").alias("freq"),
        F.lit("T").alias("sex"),
        F.lit("NR").alias("unit"),
        F.lit("TOTAL").alias("age"),
        F.col("geo").alias("geo\\TIME_PERIOD"),
        *cells,
    )


def raw_emission_sheets(emissions: DataFrame) -> dict[str, DataFrame]:
    """One wide sheet per gas. The CO2 sheet names no substance, and energy rows have untidy codes."""
    sheets = {"Fossil CO2 AR5": "CO2", "CH4_AR5": "GWP_100_AR5_CH4", "N2O_AR5": "GWP_100_AR5_N2O"}
    code = F.col("nuts_id")
    untidy = F.when(F.col("sector") == "Energy", F.concat(F.lit(" "), F.lower(code))).otherwise(code)
    years = years_of(emissions)
    kt = F.col("emissions_kt_co2e").cast("decimal(18,2)")
    cells = [F.max(F.when(F.col("year") == y, kt)).cast("string").alias(f"Y_{y}") for y in years]
    ids = ["gas", "country_iso", "country_name", "nuts_id", "nuts_label", "sector"]
    return {
        sheet: emissions.filter(F.col("gas") == gas)
        .groupBy(*ids)
        .agg(*cells)
        .select(
            F.when(F.col("gas") != "CO2", F.col("gas")).alias("Substance"),
            F.lower("country_iso").alias("ISO"),
            F.col("country_name").alias("Country"),
            untidy.alias("NUTS 2"),
            F.col("nuts_label").alias("NUTS 2 desc"),
            F.col("sector").alias("Sector"),
            *[F.col(f"Y_{y}") for y in years],
        )
        for sheet, gas in sheets.items()
    }

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arealens.operators import dense_ids, keep_first, slice_rows, top_and_bottom, top_n
from arealens.plans import bi, correlation, curated, dashboard, merged, reports, star, validate
from arealens.plans.star import Tidy
from arealens.plans.warehouse import Star, load_star, read_star
from arealens.schemas import CAUSES, DISCHARGES, EMISSIONS, POPULATION, SOURCE_ORDER
from tests.conftest import rows


def ordered(spark, schema, data):
    """A tidy table whose rows know their position, in two partitions and shuffled."""
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    numbered = [(*row, i) for i, row in enumerate(data)]
    return spark.createDataFrame(numbered[::-1], f"{names}, {SOURCE_ORDER} bigint").repartition(2)


def cause(region, year, code, rate, sex="T", age="TOTAL", unit="RT"):
    return (region, year, "A", unit, sex, age, code, rate)


def discharge(region, year, code, count, sex="T", unit="NR"):
    return (region, year, "A", "INPAT", unit, sex, "TOTAL", code, count)


EMISSION_ROWS = [
    ("AT11", None, "AT", "Austria", 2000, "CO2", "Energy", "energy", 10.0),
    ("AT11", "Burgenland", "AT", "Austria", 2000, "CO2", "Fishing", "other", 1.5),
    ("AT11", "Bgld", "AT", "Austria", 2000, "CH4", "Energy", "energy", 2.5),
    ("AT11", "Burgenland", "AT", "Austria", 2001, "CO2", "Energy", "energy", 12.0),
    ("AT12", "", "AT", "Austria", 2000, "CO2", "Waste", "waste", 4.0),
    ("AT", None, "AT", "Austria", 2000, "CO2", "Dom_Avi", "transport", 7.0),
    ("DE1", None, "DE", "Germany", 2000, "CO2", "Energy", "energy", 100.0),
    ("AT13", "Wien", "AT", "Austria", 2000, "CO2", "Energy", "energy", 8.0),
    ("AT11", "Burgenland", "AT", "Austria", 2000, "CO2", "Energy", "energy", 999.0),
    ("XX11", "Nowhere", None, None, 2000, "CO2", "Energy", "energy", 5.0),
]
CAUSE_ROWS = [
    cause("AT11", 2000, "J", 50.0, sex="F"),
    cause("AT11", 2000, "J", 60.0),
    cause("AT11", 2000, "J", 70.0, unit="NR"),
    cause("AT11", 2000, "I10", 30.0),
    cause("AT11", 2001, "J", 64.0),
    cause("AT", 2000, "J45_J46", 2.0),
    cause("FR10", 2000, "J", 1.0),
    cause(None, 2000, "J", 1.0),
]
DISCHARGE_ROWS = [
    discharge("AT11", 2000, "J", 320.0),
    discharge("AT11", 2000, "J", 100.0, sex="F"),
    discharge("AT12", 2000, "J20-J22", 10.0),
    discharge("AT13", 2000, "J", 5.0),
]
POPULATION_ROWS = [("AT11", 2000, 1000.0), ("AT11", 2001, 0.0), ("AT12", 2000, 3000.0), ("FR10", 1990, 5.0), ("AT11", 2000, 1.0)]


@pytest.fixture(scope="module")
def sources(spark):
    return Tidy(
        ordered(spark, EMISSIONS, EMISSION_ROWS),
        ordered(spark, CAUSES, CAUSE_ROWS),
        ordered(spark, DISCHARGES, DISCHARGE_ROWS),
        ordered(spark, POPULATION, POPULATION_ROWS),
    )


@pytest.fixture(scope="module")
def loaded(spark, sources, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    load_star(spark, sources, root)
    load_star(spark, sources, root)  # a load can be repeated
    return read_star(spark, root)


# --- operators --------------------------------------------------------------------------------


def test_keep_first_matches_file_order(spark):
    rng = np.random.default_rng(3)
    data = [(int(k), float(v), i) for i, (k, v) in enumerate(zip(rng.integers(0, 40, 3000), rng.normal(size=3000)))]
    df = spark.createDataFrame(data, f"k int, v double, {SOURCE_ORDER} bigint").repartition(7)
    expected = pd.DataFrame(data, columns=["k", "v", "i"]).drop_duplicates("k").set_index("k")["v"].to_dict()
    assert {r["k"]: r["v"] for r in rows(keep_first(df, ["k"], "v"))} == expected


def test_keep_first_without_order_is_deterministic(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("b", 2.0)], "k string, v double")
    assert {r["k"]: r["v"] for r in rows(keep_first(df, ["k"], "v"))} == {"a": 1.0, "b": 2.0}


def test_hot_key_is_combined_before_the_shuffle(spark):
    # Half of all rows share one grain; only one row per task and grain may be shuffled.
    df = spark.range(0, 20000, numPartitions=4).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.col("id").cast("double").alias("v"),
        F.col("id").alias(SOURCE_ORDER),
    )
    kept = keep_first(df, ["k"], "v")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange")
    assert "SortAggregate" not in plan
    assert {r["k"]: r["v"] for r in rows(kept)} == {"hot": 0.0} | {f"k{i}": float(i) for i in range(1, 50, 2)}


def test_dense_ids_follow_code_order(spark):
    codes = sorted({f"{a}{b}{i}" for a in "ABZ" for b in "XYé" for i in range(30)} | {"A", "AX", "Q", "é"})
    df = spark.createDataFrame([(c,) for c in codes], "code string").repartition(5)
    got = rows(dense_ids(df, "code", "id"), "id")
    assert [r["id"] for r in got] == list(range(1, len(codes) + 1))
    assert [r["code"] for r in got] == sorted(codes, key=lambda c: c.encode())


def test_top_and_bottom_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(f"r{i:02d}", float(i // 2)) for i in range(10)] + [("n1", None), ("n0", None)], "id string, v double")
    assert [r["id"] for r in top_n(df, "v", 3, ("id",)).collect()] == ["r08", "r09", "r06"]
    both = top_and_bottom(df, "v", 11, ("id",)).collect()
    assert len(both) == 22 and [r["id"] for r in both][10] == "n0" and both[21]["id"] == "n0"


def test_slices(spark):
    df = spark.createDataFrame([("a", 1, 2000), ("b", 2, 2001), ("b", 1, 2005)], "c string, n int, year int")
    assert slice_rows(df, years=(2000, 2001), c=[]).count() == 2
    assert slice_rows(df, c="b", n=[1, 2]).count() == 2
    assert slice_rows(df, years=(2002, None), c=None).count() == 1


# --- curated ----------------------------------------------------------------------------------


def test_emissions_by_region_year(sources):
    got = {(r["nuts_id"], r["year"]): r for r in rows(curated.emissions_by_region_year(sources.emissions))}
    first = got["AT11", 2000]
    assert first["nuts_label"] == "Burgenland"  # the first known label in source order
    assert first["total_emissions_kt"] == 1013.0
    assert (first["emissions_energy_kt"], first["emissions_other_kt"], first["emissions_waste_kt"]) == (1011.5, 1.5, 0.0)
    for r in got.values():
        assert r["total_emissions_kt"] == sum(v for k, v in r.items() if k.startswith("emissions_"))


def test_all_missing_group_sums_to_zero(spark):
    df = spark.createDataFrame([("AT11", None, "AT", "A", 2000, "g", "s", "energy", None)], EMISSIONS)
    row = rows(curated.emissions_by_region_year(df))[0]
    assert (row["total_emissions_kt"], row["emissions_energy_kt"], row["nuts_label"]) == (0.0, 0.0, None)


def test_health_means_over_the_standard_stratum(sources):
    got = {(r["nuts_id"], r["year"]): r for r in rows(curated.mortality_by_region_year(sources.causes))}
    # Two units in the stratum are averaged; the female row is not in it.
    assert got["AT11", 2000]["cod_all_resp_rate"] == 65.0
    assert got["AT11", 2000]["cod_copd_rate"] is None
    assert (None, 2000) not in got


def test_curated(sources):
    people = sources.population.filter(F.col(SOURCE_ORDER) < 4)
    got = {(r["nuts_id"], r["year"]): r for r in rows(curated.curated(sources.emissions, sources.causes, sources.discharges, people))}
    assert set(got) == {("AT11", 2000), ("AT11", 2001), ("AT12", 2000)}  # AT13 has no population, AT another level
    row = got["AT11", 2000]
    assert row["emissions_per_capita_tonnes"] == 1013.0
    assert row["discharge_all_resp"] == 320.0 and row["discharge_all_resp_per_100k"] == 32000.0
    assert row["cod_influenza_rate"] is None
    assert got["AT11", 2001]["emissions_per_capita_tonnes"] is None  # nobody lives there
    everywhere = curated.curated(sources.emissions, sources.causes, sources.discharges, people, level_only=None)
    assert everywhere.count() == 3


def test_curated_joins_do_not_shuffle_again(spark, sources):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = curated.curated(sources.emissions, sources.causes, sources.discharges, sources.population)
        text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Two for the emission steps, one for each other source.
    assert text.count("Exchange hashpartitioning") == 5


# --- star -------------------------------------------------------------------------------------


def test_geography(loaded):
    got = rows(loaded.dim_geography, "geography_id")
    assert [(r["geography_id"], r["nuts_id"], r["nuts_label"], r["nuts_level"], r["country_iso"]) for r in got] == [
        (1, "AT", "Austria", 0, "AT"),  # a country without a label takes its name
        (2, "AT11", "AT11", 2, "AT"),  # the first row has no label: the code
        (3, "AT12", "AT12", 2, "AT"),
        (4, "AT13", "Wien", 2, "AT"),
        (5, "DE1", "DE1", 1, "DE"),
    ]


def test_geography_is_the_located_part_of_the_universe(sources):
    universe = star.region_universe(sources)
    assert {r["nuts_id"] for r in rows(universe)} == {"AT", "AT11", "AT12", "AT13", "DE1", "XX11", "FR10"}
    located = universe.filter("country_iso IS NOT NULL").select("nuts_id", "country_iso", "country_name")
    dimension = star.dim_geography(sources.emissions).select("nuts_id", "country_iso", "country_name")
    assert sorted(map(tuple, located.collect())) == sorted(map(tuple, dimension.collect()))


def test_country_conflict_takes_the_first(spark):
    data = [
        ("AT11", None, None, "?", 2000, "g", "s", "energy", 1.0),
        ("AT11", "x", "AT", "Austria", 2000, "g", "s", "energy", 1.0),
        ("AT11", "x", "AA", "Aaa", 2000, "g", "s", "energy", 1.0),
    ]
    got = rows(star.dim_geography(ordered(spark, EMISSIONS, data)))
    assert [(r["country_iso"], r["country_name"], r["nuts_label"]) for r in got] == [("AT", "Austria", "AT11")]


def test_times_and_availability(loaded):
    got = {r["year"]: r for r in rows(loaded.dim_time)}
    assert set(got) == {1990, 2000, 2001}
    flags = ("is_emissions_available", "is_health_available", "is_population_available")
    assert {y: tuple(r[f] for f in flags) for y, r in got.items()} == {1990: (0, 0, 0), 2000: (1, 1, 1), 2001: (1, 1, 1)}
    assert (got[2000]["decade"], got[2000]["year_label"], got[2000]["is_leap_year"], got[2000]["quarter"]) == (2000, "2000", 1, 4)


def test_small_dimensions(loaded):
    assert [(r["sector_id"], r["sector_code"], r["sector_group"]) for r in rows(loaded.dim_sector, "sector_id")] == [
        (1, "Dom_Avi", "transport"),
        (2, "Energy", "energy"),
        (3, "Fishing", "other"),
        (4, "Waste", "waste"),
    ]
    assert [r["gas_name"] for r in rows(loaded.dim_gas, "gas_id")] == ["Methane", "Carbon Dioxide"]
    assert [r["icd10_code"] for r in rows(loaded.dim_icd10_cod, "icd10_cod_id")] == ["I10", "J", "J45_J46"]
    assert [r["is_respiratory"] for r in rows(loaded.dim_discharge_type, "discharge_type_id")] == [1, 1]


def test_facts_keep_the_first_row_of_a_grain(loaded, sources):
    causes = rows(loaded.vw_health_metrics, "nuts_id", "year", "icd10_code")
    assert [(r["nuts_id"], r["year"], r["icd10_code"], r["age_standardised_rate_per_100k"]) for r in causes] == [
        ("AT", 2000, "J45_J46", 2.0),
        ("AT11", 2000, "I10", 30.0),
        ("AT11", 2000, "J", 50.0),  # the female row comes first in the source
        ("AT11", 2001, "J", 64.0),
    ]
    standard = Star(sources, stratum="standard").vw_health_metrics.filter("icd10_code = 'J' AND year = 2000")
    assert [r["age_standardised_rate_per_100k"] for r in rows(standard)] == [60.0]
    emissions = loaded.vw_emissions.filter("nuts_id = 'AT11' AND year = 2000 AND sector_code = 'Energy' AND gas_code = 'CO2'")
    assert [r["emissions_kt_co2e"] for r in rows(emissions)] == [10.0]
    with pytest.raises(ValueError):
        Star(sources, stratum="other").fact_causes_of_death


def test_discharge_rates(loaded):
    got = {r["nuts_id"]: r for r in rows(loaded.vw_hospital_discharges)}
    assert got["AT11"]["discharge_rate_per_100k"] == 32000.0
    assert got["AT12"]["discharge_rate_per_100k"] == 333.33
    assert got["AT13"]["discharge_rate_per_100k"] is None and got["AT13"]["discharge_count"] == 5.0


def test_population_fact(loaded):
    assert {(r["time_id"], r["population"]) for r in rows(loaded.fact_population)} == {(2000, 1000), (2001, 0), (2000, 3000)}
    assert dict(loaded.fact_population.dtypes)["population"] == "bigint"
    assert {"created_date", "updated_date"} <= set(loaded.fact_population.columns)


def test_level_filter(sources):
    only = Star(sources, level_only=2)
    assert {r["nuts_id"] for r in rows(only.dim_geography)} == {"AT11", "AT12", "AT13"}
    assert {r["nuts_level"] for r in rows(only.vw_emissions)} == {2}


def test_facts_by_year_are_pruned(spark, sources, tmp_path):
    load_star(spark, sources, str(tmp_path), by_year=True)
    back = read_star(spark, str(tmp_path))
    assert back.fact_emissions.count() == Star(sources).fact_emissions.count()
    query = reports.respiratory_rates(back, 2001)
    assert [r["age_standardised_rate_per_100k"] for r in rows(query)] == [64.0]
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(time_id" in plan


def test_views_for_sql(spark, loaded):
    loaded.create_views()
    got = spark.sql(
        "SELECT country_name, SUM(emissions_kt_co2e) AS kt FROM vw_emissions GROUP BY country_name ORDER BY 1"
    ).collect()
    assert [tuple(r) for r in got] == [("Austria", 45.0), ("Germany", 100.0)]


# --- checks -----------------------------------------------------------------------------------


def test_checks_pass_on_a_load(loaded):
    counts = {r["table_name"]: r["n_rows"] for r in rows(validate.table_counts(loaded))}
    assert counts["dim_geography"] == 5 and counts["fact_emissions"] == 8 and len(counts) == 10
    assert {r["level_name"]: r["n_regions"] for r in rows(validate.level_counts(loaded))} == {"Country": 1, "NUTS1": 1, "NUTS2": 3}
    assert rows(validate.year_range(loaded)) == [{"min_year": 1990, "max_year": 2001}]
    assert {r["n_orphans"] for r in rows(validate.orphans(loaded))} == {0}
    assert {r["n_surplus"] for r in rows(validate.grain_duplicates(loaded))} == {0}
    assert {r["n_missing"] for r in rows(validate.missing_required(loaded))} == {0}
    assert {r["n_too_long"] for r in rows(validate.too_long(loaded))} == {0}


class Damaged(Star):
    """A star with a double row, an orphan and a missing value."""

    def __init__(self, whole, spark):
        super().__init__(None, keep=lambda name, build: getattr(whole, name))
        fact = whole.fact_causes_of_death.select("geography_id", "time_id", "icd10_cod_id", "age_standardised_rate_per_100k")
        extra = spark.createDataFrame([(99, 2000, 1, 5.0), (None, 2000, 1, None)], fact.schema.names and "geography_id int, time_id int, icd10_cod_id int, age_standardised_rate_per_100k double")
        self.fact_causes_of_death = fact.unionByName(fact).unionByName(extra)


def test_checks_find_damage(spark, loaded):
    bad = Damaged(loaded, spark)
    orphans = {(r["fact_name"], r["key_name"]): r["n_orphans"] for r in rows(validate.orphans(bad))}
    assert orphans["fact_causes_of_death", "geography_id"] == 2
    assert sum(orphans.values()) == 2
    surplus = {r["fact_name"]: r["n_surplus"] for r in rows(validate.grain_duplicates(bad))}
    assert surplus["fact_causes_of_death"] == 4
    missing = {(r["table_name"], r["column_name"]): r["n_missing"] for r in rows(validate.missing_required(bad))}
    assert missing["fact_causes_of_death", "geography_id"] == 1
    assert missing["fact_causes_of_death", "age_standardised_rate_per_100k"] == 1


# --- query packs ------------------------------------------------------------------------------


def test_merged_view_has_every_region_and_year(loaded):
    got = {(r["nuts_id"], r["year"]): r for r in rows(merged.vw_merged(loaded))}
    assert len(got) == 5 * 3
    full = got["AT11", 2000]
    # Joining the facts row by row would multiply the emissions by the two causes.
    assert full["total_emissions_kt"] == 14.0 and full["emissions_energy_kt"] == 12.5
    assert full["cod_all_resp_rate"] == 50.0 and full["population"] == 1000
    empty = got["DE1", 1990]
    assert empty["total_emissions_kt"] is None and empty["emissions_energy_kt"] == 0.0 and empty["population"] is None


def test_reports_match_plain_sql(spark, loaded):
    loaded.create_views()
    expected = spark.sql(
        """SELECT s.sector_name, SUM(e.emissions_kt_co2e) AS kt, SUM(p.population) AS people
           FROM fact_emissions e JOIN dim_sector s ON e.sector_id = s.sector_id
             JOIN fact_population p ON p.geography_id = e.geography_id AND p.time_id = e.time_id
           WHERE e.time_id = 2000 GROUP BY s.sector_name"""
    ).collect()
    got = rows(reports.per_capita_by_sector(loaded, 2000))
    assert {(r["sector_name"], r["total_emissions_kt"], r["total_population"]) for r in got} == {tuple(r) for r in expected}
    assert {r["sector_name"]: r["total_population"] for r in got}["Energy"] == 2000  # once per gas


def test_emissions_against_mortality_keeps_unmatched(loaded):
    got = {(r["nuts_id"], r["year"]): r["cod_all_resp_rate"] for r in rows(reports.emissions_against_mortality(loaded, 2000, 2001))}
    assert got["AT11", 2000] == 50.0 and got["AT11", 2001] == 64.0 and got["DE1", 2000] is None


def test_bi_measures_and_shares(loaded):
    cards = {r["card"]: r["value"] for r in rows(bi.measures(loaded.vw_emissions, loaded.vw_health_metrics, loaded.vw_hospital_discharges, loaded.fact_population))}
    assert cards["total_emissions"] == 145.0 and cards["emissions_per_capita"] == 145.0 / 4000
    assert cards["avg_respiratory_death_rate"] == pytest.approx((2 + 50 + 64) / 3)
    assert cards["total_hospital_discharges"] == 335.0
    nobody = bi.measures(loaded.vw_emissions, loaded.vw_health_metrics, loaded.vw_hospital_discharges, loaded.fact_population.filter("false"))
    assert {r["card"]: r["value"] for r in rows(nobody)}["emissions_per_capita"] == 0.0
    shares = rows(bi.gas_shares(loaded.vw_emissions))
    assert sum(r["share_pct"] for r in shares) == pytest.approx(100.0)


def test_lag_needs_the_neighbouring_year(spark):
    frame = spark.createDataFrame
    tables = {
        "dim_geography": frame([(1, "A", "a", "A")], "geography_id int, nuts_id string, country_name string, nuts_label string"),
        "dim_time": frame([(y, y) for y in range(1999, 2005)], "time_id int, year int"),
        "dim_icd10_cod": frame([(1, 1), (2, 0)], "icd10_cod_id int, is_respiratory int"),
        "fact_emissions": frame([(1, y, 1.0) for y in (2000, 2001, 2003)], "geography_id int, time_id int, emissions_kt_co2e double"),
        "fact_causes_of_death": frame(
            [(1, y, c, float(y * c)) for y in (2000, 2001) for c in (1, 2)],
            "geography_id int, time_id int, icd10_cod_id int, age_standardised_rate_per_100k double",
        ),
    }
    small = Star(None, keep=lambda name, build: tables[name])
    assert [(r["year"], r["death_rate_prev_year"]) for r in rows(correlation.lagged_pairs(small))] == [(2001, 2000.0)]
    ahead = correlation.lagged_pairs(small, lag_years=-1)
    assert [(r["year"], r["death_rate_prev_year"]) for r in rows(ahead)] == [(2000, 2001.0)]
    pairs = rows(correlation.region_year_pairs(small), "year")
    assert [(r["year"], r["avg_death_rate"]) for r in pairs] == [(2000, 2000.0), (2001, 2001.0)]


def test_pearson_by_country_matches_numpy(spark):
    rng = np.random.default_rng(5)
    data = [(c, float(a), float(b)) for c in "XY" for a, b in rng.normal(size=(30, 2))]
    df = spark.createDataFrame(data + [("Z", 1.0, 2.0)], "country_name string, total_emissions double, avg_death_rate double")
    got = {r["country_name"]: r for r in rows(correlation.pearson_by(df, "country_name"))}
    for c in "XY":
        x, y = zip(*[(a, b) for k, a, b in data if k == c])
        assert got[c]["pearson"] == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert got["Z"]["pearson"] is None and got["Z"]["n_pairs"] == 1


@pytest.fixture(scope="module")
def board(sources):
    people = sources.population.filter(F.col(SOURCE_ORDER) < 4)
    return curated.curated(sources.emissions, sources.causes, sources.discharges, people).cache()


def test_dashboard_slice(board):
    assert {(r["nuts_id"], r["year"]) for r in rows(dashboard.dashboard_slice(board))} == {("AT11", 2001)}
    year = dashboard.dashboard_slice(board, 2000, countries=["AT", "DE"], regions=["AT12"])
    assert [(r["region_label"], r["region_display"]) for r in rows(year)] == [("", "AT12 · ")]
    assert dashboard.dashboard_slice(board, 2000, countries=[], regions=[]).count() == 2
    assert dashboard.dashboard_slice(board, 2000, countries=["FR"]).count() == 0


def test_dashboard_tables(board):
    year = dashboard.dashboard_slice(board, 2000)
    long = {(r["nuts_id"], r["sector_group"]): r["emissions_kt"] for r in rows(dashboard.sector_breakdown(year))}
    assert len(long) == 14 and long["AT11", "Energy"] == 1011.5
    stats = {r["stat"]: r["total_emissions_kt"] for r in rows(dashboard.key_stats(year, ["total_emissions_kt", "total_emissions_kt"]))}
    assert stats == {"Mean": 508.5, "Min": 4.0, "Max": 1013.0}
    table = dashboard.comparison(year, "cod_all_resp_rate", "cod_copd_rate").collect()
    assert [r["cod_all_resp_rate"] for r in table] == [65.0, None]
    assert [r["region_display"] for r in dashboard.region_options(board).collect()] == ["AT11 · Burgenland", "AT12 · "]


def test_rates_use_the_unrounded_population(spark):
    geography = spark.createDataFrame([("AT11", 1)], "nuts_id string, geography_id int")
    kinds = spark.createDataFrame([("J", 1)], "discharge_code string, discharge_type_id int")
    people = spark.createDataFrame([("AT11", 2000, 3.5)], "geo string, year int, population double")
    row = ("AT11", 2000, "A", "INPAT", "NR", "T", "TOTAL", "J", 7.0)
    discharges = spark.createDataFrame([row], DISCHARGES)
    exact = star.population_by_key(people, geography)
    fact = star.fact_hospital_discharges(discharges, geography, kinds, exact).first()
    assert fact["discharge_rate_per_100k"] == 200000.0
    assert star.fact_population(people, geography).first()["population"] == 3


def test_failed_load_leaves_the_whole_old_star(spark, sources, tmp_path, monkeypatch):
    import arealens.plans.warehouse as warehouse
    from arealens.sources import Versions

    root = str(tmp_path / "star")
    load_star(spark, sources, root, stamp=False)
    before = {name: df.count() for name, df in read_star(spark, root).tables().items()}
    first = Versions(spark, root).current()
    written = []
    real_write = warehouse.write_table

    def dies_after_two(df, path, *args, **kwargs):
        if len(written) == 2:
            raise RuntimeError("executor lost")
        written.append(path)
        real_write(df, path, *args, **kwargs)

    monkeypatch.setattr(warehouse, "write_table", dies_after_two)
    smaller = Tidy(sources.emissions.limit(1), sources.causes.limit(1), sources.discharges.limit(1), sources.population.limit(1))
    with pytest.raises(RuntimeError):
        load_star(spark, smaller, root, stamp=False)
    monkeypatch.setattr(warehouse, "write_table", real_write)
    # Two tables of the new load are on disk, but readers still see the whole first star.
    assert len(written) == 2 and Versions(spark, root).current() == first
    assert {name: df.count() for name, df in read_star(spark, root).tables().items()} == before
    # The next whole load replaces it, and only the last two versions stay.
    load_star(spark, smaller, root, stamp=False)
    load_star(spark, sources, root, stamp=False)
    assert {name: df.count() for name, df in read_star(spark, root).tables().items()} == before
    versions = Versions(spark, root)
    assert len(versions._names("_committed")) == 2 and first not in versions._names("_v")

"""All queries by name, over the sources of a data folder.

Report years follow the years of the bound tables (1995 to 2001).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bindings
from .bindings import Sources
from .plans import bi, correlation, curated, dashboard, merged, profile, reports, star, tidy, validate
from .functions import gas_info, icd10_category, icd10_description, icd10_is_respiratory, icd10_name
from .operators import preview, slice_rows
from .plans.warehouse import load_star
from .schemas import SOURCE_ORDER
from .sources import explode_features, read_features, read_sdmx_csv, read_sheets, read_wide_tsv
from .sources.stored import coverage
from .workspace import Workspace, workspace

Query = Callable[[SparkSession, str], DataFrame]

REPORT_YEAR = 2000
REPORT_WINDOW = (1996, 2000)
CHART_YEARS = (1998, 2001)
# A dashboard selection of countries; the query itself reads the whole table.
SELECTED_COUNTRIES = ["AA", "AF", "BB", "BG", "CC", "DD", "EE"]
MAP_METRIC = "total_emissions_kt"
HEALTH_METRIC = "cod_copd_rate"

_queries: dict[str, Query] = {}


def _register(name: str, query: Query) -> None:
    _queries[name] = query


def _lazy(name: str):
    """Register a query that runs from the sources in one pass, without stored tables."""

    def add(body: Callable[[Sources], DataFrame]):
        _register(name, lambda spark, folder: body(workspace(spark, folder).sources))
        return body

    return add


def _stored(name: str):
    """Register a query over the workspace's stored tables."""

    def add(body: Callable[[Workspace], DataFrame]):
        _register(name, lambda spark, folder: body(workspace(spark, folder)))
        return body

    return add


# --- ingest -----------------------------------------------------------------------------------

_lazy("tidy_wide")(lambda s: tidy.tidy_wide(bindings.raw_causes(s.causes), "age_standardised_rate_per_100k"))
_lazy("ingest_causes")(lambda s: tidy.causes_of_death(bindings.raw_causes(s.causes)))
_lazy("ingest_causes_level2")(lambda s: tidy.causes_of_death(bindings.raw_causes(s.causes), level_only=2))
_lazy("ingest_discharges")(lambda s: tidy.hospital_discharges(bindings.raw_discharges(s.discharges)))
_lazy("ingest_population")(lambda s: tidy.population(bindings.raw_population(s.population)))
_lazy("ingest_population_long")(lambda s: tidy.population(bindings.raw_population_long(s.population)))
_lazy("ingest_population_flagged")(lambda s: tidy.population(bindings.raw_population_flagged(s.population)))
_stored("ingest_emissions")(lambda w: tidy.emissions(bindings.raw_emission_sheets(w.emissions)))


# The same plans over files: the raw layouts of all rows, written by Spark and read by the readers.


def _written(w: Workspace, name: str, df: DataFrame, **options) -> str:
    """The path of a delimited text copy of a raw layout, blanks kept."""
    path = w.scratch(name)
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, **blanks, **options).csv(path)
    return path


def _unordered(df: DataFrame) -> DataFrame:
    return df.drop(SOURCE_ORDER)


@_stored("scan_wide_tsv")
def _scan_wide_tsv(w: Workspace) -> DataFrame:
    path = _written(w, "causes.tsv", bindings.raw_causes(w.causes), sep="\t")
    return _unordered(tidy.causes_of_death(read_wide_tsv(w.spark, path)))


@_stored("scan_sdmx_csv")
def _scan_sdmx_csv(w: Workspace) -> DataFrame:
    path = _written(w, "population.csv", bindings.raw_population_long(w.population))
    return _unordered(tidy.population(read_sdmx_csv(w.spark, path)))


@_stored("scan_sheets")
def _scan_sheets(w: Workspace) -> DataFrame:
    sheets = bindings.raw_emission_sheets(w.emissions)
    # A sheet is one file; its rows are regions and sectors, not source rows.
    paths = {name: _written(w, f"sheet{i}.csv", df.coalesce(1)) for i, (name, df) in enumerate(sheets.items())}
    return _unordered(tidy.emissions(read_sheets(w.spark, paths)))


@_stored("scan_geojson")
def _scan_geojson(w: Workspace) -> DataFrame:
    path = w.scratch("regions.geojsonl")
    explode_features(w.sources.features).write.mode("overwrite").json(path)
    shapes = dashboard.region_features(read_features(w.spark, path, lines=True))
    return shapes.select("nuts_id", F.col("properties")["LEVL_CODE"].cast("int").alias("level"), F.col("geometry.type").alias("shape"))


@_stored("load_or_build_population")
def _load_or_build_population(w: Workspace) -> DataFrame:
    path = _written(w, "population.tsv", bindings.raw_population(w.population), sep="\t")
    stored = w.scratch("population-stored")
    tidy.load_population(w.spark, stored, path, force_refresh=True)
    # The second call finds the stored table and reads no raw file.
    return _unordered(tidy.load_population(w.spark, stored, None))


@_stored("star_stamped")
def _star_stamped(w: Workspace) -> DataFrame:
    """Rows and stamped rows of every table of a full, stamped load."""
    star = load_star(w.spark, w.tidy, w.scratch("star"))
    parts = [
        df.select(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.count("created_date").alias("n_stamped"))
        for name, df in star.tables().items()
    ]
    return reduce(DataFrame.unionByName, parts)


@_lazy("population_coverage")
def _population_coverage(s: Sources) -> DataFrame:
    """What the choice between candidate population sources is based on."""
    people = s.population
    candidates = {
        "interface": tidy.population(bindings.raw_population_long(people)),
        "file": tidy.population(bindings.raw_population(people)),
    }
    return coverage(candidates)


# --- curated ----------------------------------------------------------------------------------

_lazy("emissions_wide")(lambda s: curated.emissions_by_region_year(s.emissions))
_lazy("causes_wide")(lambda s: curated.mortality_by_region_year(s.causes))
_lazy("discharges_wide")(lambda s: curated.discharges_by_region_year(s.discharges))


@_lazy("curated")
def _curated(s: Sources) -> DataFrame:
    return curated.curated(s.emissions, s.causes, s.discharges, s.population)


_lazy("curated_all_levels")(
    lambda s: curated.curated(s.emissions, s.causes, s.discharges, s.population, level_only=None)
)

_lazy("curated_window")(
    lambda s: curated.curated(s.emissions, s.causes, s.discharges, s.population, years=REPORT_WINDOW)
)
_stored("curated_preview")(lambda w: preview(w.curated, "nuts_id", "year"))

# --- star -------------------------------------------------------------------------------------

_stored("region_universe")(lambda w: star.region_universe(w.tidy))
_stored("dim_geography")(lambda w: star.dim_geography(w.emissions))
_stored("dim_sector")(lambda w: star.dim_sector(w.emissions))
_stored("dim_gas")(lambda w: star.dim_gas(w.emissions))
_stored("dim_icd10_cod")(lambda w: star.dim_icd10_cod(w.causes))
_stored("dim_discharge_type")(lambda w: star.dim_discharge_type(w.discharges))


@_stored("dim_time")
def _dim_time(w: Workspace) -> DataFrame:
    s = w.star
    return star.with_availability(star.dim_time(w.tidy), s.fact_emissions, s.fact_causes_of_death, s.fact_population)


@_lazy("icd10_rules")
def _icd10_rules(s: Sources) -> DataFrame:
    code = F.col("code")
    named = bindings.rule_codes(s.table("part"), "p_partkey", bindings.RULE_CODES).withColumns(
        {"name": icd10_name(code), "category": icd10_category(code), "is_respiratory": icd10_is_respiratory(code)}
    )
    return named.withColumn("description", icd10_description(F.col("name"), F.col("category")))


@_lazy("gas_rules")
def _gas_rules(s: Sources) -> DataFrame:
    gases = bindings.rule_codes(s.table("part"), "p_partkey", bindings.RULE_GASES)
    return gases.withColumn("_info", gas_info(F.col("code"))).select("code", "n_rows", "_info.*")


_stored("fact_population")(lambda w: star.fact_population(w.population, w.star.dim_geography))
_stored("fact_emissions")(
    lambda w: star.fact_emissions(w.emissions, w.star.dim_geography, w.star.dim_sector, w.star.dim_gas)
)
_stored("fact_causes")(
    lambda w: star.fact_causes_of_death(w.causes, w.star.dim_geography, w.star.dim_icd10_cod)
)
_stored("fact_causes_standard")(
    lambda w: star.fact_causes_of_death(w.causes, w.star.dim_geography, w.star.dim_icd10_cod, "standard")
)
_stored("fact_discharges")(
    lambda w: star.fact_hospital_discharges(
        w.discharges,
        w.star.dim_geography,
        w.star.dim_discharge_type,
        star.population_by_key(w.population, w.star.dim_geography),
    )
)
_stored("vw_emissions")(lambda w: w.star.vw_emissions)
_stored("vw_health_metrics")(lambda w: w.star.vw_health_metrics)
_stored("vw_hospital_discharges")(lambda w: w.star.vw_hospital_discharges)
_stored("vw_merged")(lambda w: merged.vw_merged(w.star))

# --- checks -----------------------------------------------------------------------------------

_stored("verify_counts")(lambda w: validate.table_counts(w.star))
_stored("verify_levels")(lambda w: validate.level_counts(w.star))
_stored("verify_years")(lambda w: validate.year_range(w.star))
_stored("verify_orphans")(lambda w: validate.orphans(w.star))
_stored("verify_grain")(lambda w: validate.grain_duplicates(w.star))
_stored("verify_required")(lambda w: validate.missing_required(w.star))
_stored("verify_lengths")(lambda w: validate.too_long(w.star))

# --- profile ----------------------------------------------------------------------------------


@_stored("profile_source")
def _profile_source(w: Workspace) -> DataFrame:
    causes = profile.source_summary(
        bindings.raw_causes(w.causes), "causes", {"geo_codes": "geo", "icd10_groups": "icd10"}
    )
    emissions = profile.tidy_summary(
        w.emissions, "emissions", {"regions": "nuts_id", "countries": "country_iso", "sectors": "sector"}
    )
    return causes.unionByName(emissions)


@_stored("profile_sheets")
def _profile_sheets(w: Workspace) -> DataFrame:
    sheets = bindings.raw_emission_sheets(w.emissions)
    return reduce(DataFrame.unionByName, [profile.sheet_summary(df, sheet) for sheet, df in sheets.items()])


@_stored("profile_missing")
def _profile_missing(w: Workspace) -> DataFrame:
    sheets = bindings.raw_emission_sheets(w.emissions)
    parts = [profile.missing_cells(df, sheet, r"Y_(\d{4})") for sheet, df in sheets.items()]
    return reduce(DataFrame.unionByName, parts)


_lazy("profile_completeness")(lambda s: profile.completeness(bindings.raw_causes(s.causes)))
_lazy("profile_population_completeness")(
    lambda s: profile.population_completeness(bindings.raw_population(s.population))
)
_stored("profile_levels")(lambda w: profile.code_levels(w.causes))
_lazy("profile_level_names")(lambda s: profile.named_levels(profile.raw_dimensions(bindings.raw_population(s.population))))
_stored("profile_code_sample")(lambda w: profile.code_sample(w.emissions))
_stored("profile_respiratory_codes")(lambda w: profile.respiratory_codes(w.causes))


def _by_source(w: Workspace) -> dict[str, DataFrame]:
    return {
        "emissions": w.emissions,
        "causes": w.causes,
        "discharges": w.discharges,
        "population": w.population.withColumnRenamed("geo", "nuts_id"),
    }


_stored("coverage_overlap")(lambda w: profile.region_overlap(_by_source(w), all_levels=("emissions",)))
_stored("coverage_overlap_level2")(lambda w: profile.region_overlap(_by_source(w)))
_stored("harmonization_window")(lambda w: profile.harmonization_window(_by_source(w)))

# --- dashboard --------------------------------------------------------------------------------

_stored("dash_slice")(lambda w: dashboard.dashboard_slice(w.curated))
_stored("dash_slice_selected")(
    lambda w: dashboard.dashboard_slice(w.curated, REPORT_YEAR, countries=SELECTED_COUNTRIES)
)
_stored("dash_top_bottom")(
    lambda w: dashboard.top_and_bottom_regions(dashboard.dashboard_slice(w.curated, REPORT_YEAR), HEALTH_METRIC)
)
_stored("dash_key_stats")(
    lambda w: dashboard.key_stats(dashboard.dashboard_slice(w.curated, REPORT_YEAR), [MAP_METRIC, HEALTH_METRIC])
)
_stored("dash_comparison")(
    lambda w: dashboard.comparison(dashboard.dashboard_slice(w.curated, REPORT_YEAR), MAP_METRIC, HEALTH_METRIC)
)
_stored("dash_sector_long")(
    lambda w: dashboard.sector_breakdown(dashboard.dashboard_slice(w.curated, REPORT_YEAR))
)
_stored("dash_region_options")(lambda w: dashboard.region_options(w.curated))
_stored("dash_year_range")(lambda w: dashboard.year_range(w.curated))
_stored("dash_country_options")(lambda w: dashboard.country_options(w.curated))


@_lazy("geo_features")
def _geo_features(s: Sources) -> DataFrame:
    shapes = dashboard.region_features(explode_features(s.features))
    return shapes.select("nuts_id", F.col("properties")["LEVL_CODE"].cast("int").alias("level"), F.col("geometry.type").alias("shape"))


@_stored("geo_region_map")
def _geo_region_map(w: Workspace) -> DataFrame:
    rows = dashboard.dashboard_slice(w.curated, REPORT_YEAR)
    shapes = dashboard.region_map(rows, explode_features(w.sources.features), MAP_METRIC)
    return shapes.select("nuts_id", "region_label", "country_iso", MAP_METRIC, F.col("geometry.type").alias("shape"))


# --- report queries ---------------------------------------------------------------------------

_stored("q1_country_year")(lambda w: reports.emissions_by_country_year(w.star))
_stored("q2_resp_rates")(lambda w: reports.respiratory_rates(w.star, REPORT_YEAR))
_stored("q3_emissions_vs_health")(lambda w: reports.emissions_against_mortality(w.star, *REPORT_WINDOW))
_stored("q4_per_capita_sector")(lambda w: reports.per_capita_by_sector(w.star, REPORT_YEAR))
_stored("q5_discharge_rates")(lambda w: reports.discharge_rates_by_country(w.star, REPORT_YEAR))

_stored("bi_emissions_country")(lambda w: bi.emissions_by_country(w.star.vw_emissions))
_stored("bi_emissions_year")(lambda w: bi.emissions_by_year(w.star.vw_emissions))
_stored("bi_emissions_trend_top5")(lambda w: bi.emissions_trend_top_countries(w.star.vw_emissions))
_stored("bi_emissions_sector_year")(lambda w: bi.emissions_by_sector_year(w.star.vw_emissions))
_stored("bi_gas_share")(lambda w: bi.gas_shares(w.star.vw_emissions))
_stored("bi_top10_emitters")(lambda w: bi.top_emitting_regions(w.star.vw_emissions))
_stored("bi_top5_emitting_countries")(lambda w: bi.top_emitting_countries(w.star.vw_emissions))


@_stored("bi_emissions_sliced")
def _emissions_sliced(w: Workspace) -> DataFrame:
    """The emissions chart under all its slicers."""
    rows = slice_rows(
        w.star.vw_emissions,
        years=CHART_YEARS,
        sector_group=["energy", "transport"],
        gas_name="Methane",
        nuts_level=[1, 2],
    )
    return bi.emissions_by_sector_year(rows)


_stored("bi_death_rate_country")(lambda w: bi.death_rate_by_country(w.star.vw_health_metrics))
_stored("bi_death_rate_year")(lambda w: bi.death_rate_by_year(w.star.vw_health_metrics))
_stored("bi_death_rate_trend")(lambda w: bi.death_rate_trend_top_countries(w.star.vw_health_metrics))
_stored("bi_rate_by_category")(lambda w: bi.death_rate_by_category(w.star.vw_health_metrics))
_stored("bi_discharge_rate_country")(lambda w: bi.discharge_rate_by_country(w.star.vw_hospital_discharges))
_stored("bi_top10_death_rate")(lambda w: bi.top_death_rate_regions(w.star.vw_health_metrics))
_stored("bi_top5_death_rate_countries")(lambda w: bi.top_death_rate_countries(w.star.vw_health_metrics))
_stored("bi_cards")(lambda w: bi.overview_cards(w.star.vw_emissions, w.star.vw_health_metrics))
_stored("bi_measures")(
    lambda w: bi.measures(
        w.star.vw_emissions, w.star.vw_health_metrics, w.star.vw_hospital_discharges, w.star.fact_population
    )
)


def _pairs(w: Workspace) -> DataFrame:
    return correlation.region_year_pairs(w.star)


def _rounded(df: DataFrame) -> DataFrame:
    # Correlations are compared with another engine's, which adds up in another order.
    return df.withColumn("pearson", F.round("pearson", 9))


_stored("corr_data")(_pairs)
_stored("corr_matrix")(lambda w: correlation.country_matrix(_pairs(w)))
_stored("corr_pearson")(lambda w: _rounded(correlation.pearson_by(_pairs(w), "country_name")))
_stored("corr_pearson_overall")(lambda w: _rounded(correlation.pearson_overall(_pairs(w))))
_stored("corr_by_sector")(lambda w: correlation.sector_pairs(w.star))
_stored("corr_pearson_sector")(
    lambda w: _rounded(correlation.pearson_by(correlation.sector_pairs(w.star), "sector_group"))
)
_stored("corr_timeseries")(
    lambda w: correlation.yearly_comparison(w.star.vw_emissions, w.star.vw_health_metrics, CHART_YEARS)
)
_stored("corr_regional_top10")(lambda w: correlation.top_regions(_pairs(w)))
_stored("lag_analysis")(lambda w: correlation.lagged_pairs(w.star))
_stored("lag_by_year")(lambda w: correlation.lag_by_year(correlation.lagged_pairs(w.star)))


def queries() -> dict[str, Query]:
    return dict(_queries)

"""The catalog's queries in SQL, for comparison with an independent engine.

Every statement starts with the same common table expressions: the statistics sources derived from
the given tables (``FX``) and, where needed, the curated table (``CURATED``) or the star schema
(``STAR``). Sums of two-decimal values are taken as decimals, so they do not depend on the order.
"""

from __future__ import annotations

from itertools import combinations

FX = """
fx_geo AS (
  SELECT c_custkey, n_nationkey, n_name AS country_name,
    substr(chr(65 + n_regionkey) || chr(65 + n_nationkey)
        || CAST(c_custkey % 3 AS STRING)
        || CAST(CAST(floor(c_custkey / 3) AS INT) % 3 AS STRING)
        || CAST(CAST(floor(c_custkey / 9) AS INT) % 4 AS STRING),
        1, CAST(2 + c_custkey % 4 AS INT)) AS nuts_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
fx_emissions AS (
  SELECT nuts_id,
    CASE WHEN length(nuts_id) = 2 THEN NULL ELSE 'Region ' || nuts_id END AS nuts_label,
    substr(nuts_id, 1, 2) AS country_iso, country_name,
    CAST(year(l_shipdate) AS INT) AS year,
    CASE l_returnflag WHEN 'R' THEN 'GWP_100_AR5_CH4' WHEN 'A' THEN 'CO2' ELSE 'GWP_100_AR5_N2O' END AS gas,
    CASE p_type WHEN 'ECONOMY' THEN 'Agriculture' WHEN 'SMALL' THEN 'Buildings' WHEN 'MEDIUM' THEN 'Energy'
      WHEN 'PROMO' THEN 'Transport' WHEN 'STANDARD' THEN 'Dom_Avi' ELSE 'Unlisted' END AS sector,
    CASE p_type WHEN 'ECONOMY' THEN 'agriculture' WHEN 'SMALL' THEN 'buildings' WHEN 'MEDIUM' THEN 'energy'
      WHEN 'PROMO' THEN 'transport' WHEN 'STANDARD' THEN 'transport' ELSE 'other' END AS sector_group,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS emissions_kt_co2e
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN fx_geo ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey
  GROUP BY ALL),
fx_causes AS (
  SELECT o_orderkey AS src_ord, nuts_id, CAST(year(o_orderdate) AS INT) AS year,
    'A' AS frequency, 'RT' AS unit_code,
    CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'T' ELSE 'M' END AS sex,
    CASE WHEN o_orderkey % 5 = 0 THEN 'Y_GE65' ELSE 'TOTAL' END AS age_group,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'J' WHEN '2' THEN 'J12-J18' WHEN '3' THEN 'J40-J44_J47'
      WHEN '4' THEN 'I20-I25' ELSE 'C00-D48' END AS icd10_group,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS age_standardised_rate_per_100k
  FROM orders JOIN fx_geo ON o_custkey = c_custkey),
fx_discharges AS (
  SELECT event_id AS src_ord, nuts_id, CAST(1995 + event_id % 7 AS INT) AS year,
    'A' AS frequency, 'INPAT' AS indicator, 'NR' AS unit_code,
    CASE event_id % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' ELSE 'M' END AS sex, 'TOTAL' AS age_group,
    CASE event_type WHEN 'view' THEN 'J' WHEN 'click' THEN 'J00-J11' WHEN 'error' THEN 'J20-J22'
      WHEN 'purchase' THEN 'J45_J46' ELSE 'A-T_Z' END AS icd10_group,
    CAST(floor(value) AS DOUBLE) AS discharges
  FROM events JOIN fx_geo ON user_id = c_custkey),
fx_population AS (
  SELECT nuts_id AS geo, y AS year, CAST(SUM(1000 + c_custkey) AS DOUBLE) AS population
  FROM fx_geo CROSS JOIN (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders) t
  GROUP BY nuts_id, y),
fx_years AS (SELECT DISTINCT year AS y FROM fx_causes),
fx_cells AS (
  SELECT frequency, unit_code || '_' || src_ord AS unit_code, sex, age_group, icd10_group, nuts_id, y AS year,
    year = y AS filled,
    CASE WHEN year = y AND NOT (sex = 'F' AND y = 1999) THEN age_standardised_rate_per_100k END
      AS age_standardised_rate_per_100k
  FROM fx_causes CROSS JOIN fx_years)
"""

GROUPS = ("agriculture", "buildings", "energy", "industry", "other", "transport", "waste")
MORTALITY = {
    "J": "cod_all_resp_rate",
    "J09-J11": "cod_influenza_rate",
    "J12-J18": "cod_pneumonia_rate",
    "J40-J44_J47": "cod_copd_rate",
    "J45_J46": "cod_asthma_rate",
}
DISCHARGES = {
    "J": "discharge_all_resp",
    "J00-J11": "discharge_upper_resp",
    "J12-J18": "discharge_pneumonia",
    "J20-J22": "discharge_bronchitis",
    "J40-J44_J47": "discharge_copd",
    "J45_J46": "discharge_asthma",
    "J60-J99": "discharge_other_resp",
}
COUNTRIES = ("AA", "AF", "BB", "BG", "CC", "DD", "EE")


def _sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,2))) AS DOUBLE)"


def _avg(x: str) -> str:
    return f"({_sum(x)} / NULLIF(COUNT({x}), 0))"


def _avg12(x: str) -> str:
    """Average of values with repeating decimals: taken to decimals from their shortest digits."""
    return f"(CAST(SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def _list(*items: str) -> str:
    return ",\n  ".join(items)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


# --- curated ----------------------------------------------------------------------------------

_sector_columns = [
    f"coalesce({_sum(f'CASE WHEN sector_group = {g!r} THEN emissions_kt_co2e END')}, 0.0) AS emissions_{g}_kt"
    for g in GROUPS
]
_cod_columns = [
    _avg(f"CASE WHEN icd10_group = '{code}' THEN age_standardised_rate_per_100k END") + f" AS {name}"
    for code, name in MORTALITY.items()
]
_discharge_columns = [
    _avg(f"CASE WHEN icd10_group = '{code}' THEN discharges END") + f" AS {name}" for code, name in DISCHARGES.items()
]


def _in(codes) -> str:
    return "(" + ", ".join(f"'{c}'" for c in codes) + ")"


WIDE = f"""
emissions_wide AS (
  SELECT nuts_id, year, MIN(nuts_label) AS nuts_label, MIN(country_iso) AS country_iso,
    MIN(country_name) AS country_name, coalesce({_sum('emissions_kt_co2e')}, 0.0) AS total_emissions_kt,
    {_list(*_sector_columns)}
  FROM fx_emissions GROUP BY nuts_id, year),
causes_wide AS (
  SELECT nuts_id, year, {_list(*_cod_columns)}
  FROM fx_causes
  WHERE frequency = 'A' AND sex = 'T' AND age_group = 'TOTAL' AND icd10_group IN {_in(MORTALITY)}
  GROUP BY nuts_id, year),
discharges_wide AS (
  SELECT nuts_id, year, {_list(*_discharge_columns)}
  FROM fx_discharges
  WHERE frequency = 'A' AND sex = 'T' AND age_group = 'TOTAL' AND icd10_group IN {_in(DISCHARGES)}
  GROUP BY nuts_id, year)
"""
CURATED = f"""
curated_all AS (
  SELECT e.*, p.population, {_list(*[f'c.{n}' for n in MORTALITY.values()])},
    {_list(*[f'd.{n}' for n in DISCHARGES.values()])},
    e.total_emissions_kt * 1000.0::DOUBLE / NULLIF(p.population, 0) AS emissions_per_capita_tonnes,
    {_list(*[f'd.{n} / NULLIF(p.population, 0) * 100000.0::DOUBLE AS {n}_per_100k' for n in DISCHARGES.values()])}
  FROM emissions_wide e
  JOIN fx_population p ON p.geo = e.nuts_id AND p.year = e.year
  LEFT JOIN causes_wide c ON c.nuts_id = e.nuts_id AND c.year = e.year
  LEFT JOIN discharges_wide d ON d.nuts_id = e.nuts_id AND d.year = e.year),
curated AS (SELECT * FROM curated_all WHERE length(trim(nuts_id)) = 4)
"""
DASH = """
labelled AS (
  SELECT *, coalesce(nuts_label, nuts_id) AS region_label,
    nuts_id || ' · ' || coalesce(nuts_label, nuts_id) AS region_display
  FROM curated),
slice2000 AS (SELECT * FROM labelled WHERE year = 2000)
"""

# --- star -------------------------------------------------------------------------------------


def _level(code: str) -> str:
    return f"CASE length(trim({code})) WHEN 2 THEN 0 WHEN 3 THEN 1 WHEN 4 THEN 2 ELSE 3 END"


_LEVEL_NAME = "CASE {} WHEN 0 THEN 'Country' WHEN 1 THEN 'NUTS1' WHEN 2 THEN 'NUTS2' ELSE 'NUTS3+' END"

# The cause codes that occur in the derived sources.
_ICD = """
icd AS (
  SELECT * FROM (VALUES
    ('J', 'All respiratory diseases', 'all_respiratory'),
    ('J12-J18', 'Pneumonia', 'respiratory'),
    ('J40-J44_J47', 'Chronic lower respiratory diseases (COPD)', 'respiratory'),
    ('J00-J11', 'Acute upper respiratory infections', 'respiratory'),
    ('J20-J22', 'Other acute lower respiratory infections', 'respiratory'),
    ('J45_J46', 'Asthma', 'respiratory'),
    ('I20-I25', 'Ischaemic heart diseases', 'circulatory'),
    ('C00-D48', 'Neoplasm (C00-D48)', 'neoplasms'),
    ('A-T_Z', 'All diseases and health factors (A-T, Z)', 'all_conditions')) t(code, name, category))
"""
STAR = f"""
{_ICD.strip()},
geo_base AS (
  SELECT nuts_id, MIN(nuts_label) AS nuts_label, MIN(country_iso) AS country_iso, MIN(country_name) AS country_name,
    {_level('nuts_id')} AS nuts_level
  FROM fx_emissions WHERE country_iso IS NOT NULL GROUP BY nuts_id),
dim_geography AS (
  SELECT CAST(row_number() OVER (ORDER BY nuts_id) AS INT) AS geography_id, nuts_id,
    coalesce(nullif(nuts_label, ''), CASE WHEN nuts_level = 0 THEN nullif(country_name, '') END, nuts_id) AS nuts_label,
    CAST(nuts_level AS INT) AS nuts_level, country_iso, country_name
  FROM geo_base),
dim_sector AS (
  SELECT CAST(row_number() OVER (ORDER BY sector) AS INT) AS sector_id, sector AS sector_code, sector AS sector_name,
    sector_group, CAST(NULL AS VARCHAR) AS sector_description, 1 AS is_active
  FROM (SELECT DISTINCT sector, sector_group FROM fx_emissions) t),
dim_gas AS (
  SELECT CAST(row_number() OVER (ORDER BY gas) AS INT) AS gas_id, gas AS gas_code,
    CASE gas WHEN 'CO2' THEN 'Carbon Dioxide' WHEN 'GWP_100_AR5_CH4' THEN 'Methane' ELSE 'Nitrous Oxide' END AS gas_name,
    CASE gas WHEN 'CO2' THEN 'CO₂' WHEN 'GWP_100_AR5_CH4' THEN 'CH₄' ELSE 'N₂O' END AS gas_formula,
    CAST(CASE gas WHEN 'CO2' THEN 1 WHEN 'GWP_100_AR5_CH4' THEN 28 ELSE 265 END AS DOUBLE) AS gwp_ar5, 1 AS is_active
  FROM (SELECT DISTINCT gas FROM fx_emissions) t),
dim_icd10_cod AS (
  SELECT CAST(row_number() OVER (ORDER BY icd10_group) AS INT) AS icd10_cod_id, icd10_group AS icd10_code,
    name AS icd10_name, category AS icd10_category,
    name || ' (' || replace(category, '_', ' ') || ')' AS icd10_description,
    CASE WHEN icd10_group LIKE 'J%' THEN 1 ELSE 0 END AS is_respiratory, 1 AS is_active
  FROM (SELECT DISTINCT icd10_group FROM fx_causes) t LEFT JOIN icd ON code = icd10_group),
dim_discharge_type AS (
  SELECT CAST(row_number() OVER (ORDER BY icd10_group) AS INT) AS discharge_type_id, icd10_group AS discharge_code,
    name AS discharge_name, category AS discharge_category, icd10_group AS icd10_codes,
    name || ' (' || replace(category, '_', ' ') || ')' AS discharge_description,
    CASE WHEN icd10_group LIKE 'J%' THEN 1 ELSE 0 END AS is_respiratory, 1 AS is_active
  FROM (SELECT DISTINCT icd10_group FROM fx_discharges) t LEFT JOIN icd ON code = icd10_group),
fact_population AS (
  SELECT geography_id, year AS time_id, CAST(population AS BIGINT) AS population
  FROM fx_population JOIN dim_geography ON nuts_id = geo),
fact_emissions AS (
  SELECT geography_id, year AS time_id, sector_id, gas_id, emissions_kt_co2e
  FROM fx_emissions e JOIN dim_geography g ON g.nuts_id = e.nuts_id
    JOIN dim_sector ON sector_code = sector JOIN dim_gas ON gas_code = gas),
first_causes AS (
  SELECT * FROM fx_causes WHERE age_standardised_rate_per_100k IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY nuts_id, year, icd10_group ORDER BY src_ord) = 1),
first_causes_standard AS (
  SELECT * FROM fx_causes
  WHERE age_standardised_rate_per_100k IS NOT NULL AND frequency = 'A' AND sex = 'T' AND age_group = 'TOTAL'
  QUALIFY row_number() OVER (PARTITION BY nuts_id, year, icd10_group ORDER BY src_ord) = 1),
first_discharges AS (
  SELECT * FROM fx_discharges WHERE discharges IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY nuts_id, year, icd10_group ORDER BY src_ord) = 1),
fact_causes_of_death AS (
  SELECT geography_id, year AS time_id, icd10_cod_id, age_standardised_rate_per_100k
  FROM first_causes c JOIN dim_geography g ON g.nuts_id = c.nuts_id JOIN dim_icd10_cod ON icd10_code = icd10_group),
fact_hospital_discharges AS (
  SELECT f.geography_id, f.time_id, f.discharge_type_id, f.discharge_count,
    round_even(f.discharge_count / NULLIF(CAST(p.population AS DOUBLE), 0) * 100000.0::DOUBLE * 100.0::DOUBLE, 0)
      / 100.0::DOUBLE AS discharge_rate_per_100k
  FROM (SELECT geography_id, year AS time_id, discharge_type_id, discharges AS discharge_count
        FROM first_discharges d JOIN dim_geography g ON g.nuts_id = d.nuts_id
          JOIN dim_discharge_type ON discharge_code = icd10_group) f
    LEFT JOIN fact_population p ON p.geography_id = f.geography_id AND p.time_id = f.time_id),
years AS (
  SELECT year FROM fx_emissions UNION SELECT year FROM fx_causes UNION SELECT year FROM fx_discharges
  UNION SELECT year FROM fx_population),
dim_time AS (
  SELECT year AS time_id, year, CAST(floor(year / 10) * 10 AS INT) AS decade, CAST(year AS VARCHAR) AS year_label,
    CASE WHEN (year % 4 = 0 AND year % 100 <> 0) OR year % 400 = 0 THEN 1 ELSE 0 END AS is_leap_year, 4 AS quarter,
    CASE WHEN year IN (SELECT time_id FROM fact_emissions) THEN 1 ELSE 0 END AS is_emissions_available,
    CASE WHEN year IN (SELECT time_id FROM fact_causes_of_death) THEN 1 ELSE 0 END AS is_health_available,
    CASE WHEN year IN (SELECT time_id FROM fact_population) THEN 1 ELSE 0 END AS is_population_available
  FROM years),
vw_emissions AS (
  SELECT nuts_id, nuts_label, nuts_level, country_iso, country_name, year, decade, sector_code, sector_name,
    sector_group, gas_code, gas_name, emissions_kt_co2e
  FROM fact_emissions JOIN dim_geography USING (geography_id) JOIN dim_time USING (time_id)
    JOIN dim_sector USING (sector_id) JOIN dim_gas USING (gas_id)),
vw_health_metrics AS (
  SELECT nuts_id, nuts_label, nuts_level, country_iso, country_name, year, decade, icd10_code, icd10_name,
    icd10_category, is_respiratory, age_standardised_rate_per_100k
  FROM fact_causes_of_death JOIN dim_geography USING (geography_id) JOIN dim_time USING (time_id)
    JOIN dim_icd10_cod USING (icd10_cod_id)),
vw_hospital_discharges AS (
  SELECT nuts_id, nuts_label, nuts_level, country_iso, country_name, year, decade, discharge_code, discharge_name,
    discharge_category, is_respiratory, discharge_count, discharge_rate_per_100k
  FROM fact_hospital_discharges JOIN dim_geography USING (geography_id) JOIN dim_time USING (time_id)
    JOIN dim_discharge_type USING (discharge_type_id))
"""

_rate = "age_standardised_rate_per_100k"
PAIRS = f"""
region_emissions AS (
  SELECT nuts_id, country_name, nuts_label, year, {_sum('emissions_kt_co2e')} AS total_emissions
  FROM vw_emissions GROUP BY ALL),
region_rates AS (
  SELECT nuts_id, country_name, nuts_label, year, {_avg(_rate)} AS avg_death_rate
  FROM vw_health_metrics WHERE is_respiratory = 1 GROUP BY ALL),
pairs AS (SELECT * FROM region_emissions NATURAL JOIN region_rates),
sector_emissions AS (
  SELECT nuts_id, country_name, year, sector_group, {_sum('emissions_kt_co2e')} AS total_emissions
  FROM vw_emissions GROUP BY ALL),
sector_pairs AS (
  SELECT nuts_id, country_name, year, sector_group, total_emissions, avg_death_rate
  FROM sector_emissions NATURAL JOIN (SELECT nuts_id, country_name, year, avg_death_rate FROM region_rates) r),
lagged AS (
  SELECT e.nuts_id, e.country_name, e.year, e.total_emissions AS emissions, r.avg_death_rate AS death_rate_prev_year
  FROM region_emissions e JOIN region_rates r
    ON r.nuts_id = e.nuts_id AND r.country_name = e.country_name AND r.year + 1 = e.year)
"""
_pearson = (
    "COUNT(*) AS n_pairs, CASE WHEN isnan(corr(total_emissions, avg_death_rate)) THEN NULL "
    "ELSE round(corr(total_emissions, avg_death_rate), 9) END AS pearson"
)

# --- statements -------------------------------------------------------------------------------

_fx = _with(FX)
_wide = _with(FX, WIDE)
_curated = _with(FX, WIDE, CURATED)
_dash = _with(FX, WIDE, CURATED, DASH)
_star = _with(FX, STAR)
_pairs = _with(FX, STAR, PAIRS)

_level2 = "length(nuts_id) = 4"
_names = ("emissions", "causes", "discharges", "population")


def _sets(column: str, where: str = "TRUE", everywhere: tuple[str, ...] = ()) -> str:
    geo = "geo AS nuts_id"
    return ",\n".join(
        f"s_{n} AS (SELECT DISTINCT v FROM (SELECT {column} AS v, * FROM (SELECT *{', ' + geo if n == 'population' else ''}"
        f" FROM fx_{n}) q) t WHERE {'TRUE' if n in everywhere else where})"
        for n in _names
    )


def _overlaps(select: str) -> str:
    parts = [f"SELECT '{n}' AS measure, {select} FROM s_{n}" for n in _names]
    parts += [
        f"SELECT '{a} & {b}', {select} FROM s_{a} WHERE v IN (SELECT v FROM s_{b})" for a, b in combinations(_names, 2)
    ]
    union = " UNION ".join(f"SELECT v FROM s_{n}" for n in _names)
    shared = " INTERSECT ".join(f"SELECT v FROM s_{n}" for n in _names)
    parts += [f"SELECT 'union', {select} FROM ({union}) u", f"SELECT 'intersection', {select} FROM ({shared}) i"]
    return "\nUNION ALL ".join(parts)


_required = {
    "dim_geography": ("nuts_id", "nuts_level", "country_iso"),
    "dim_time": ("time_id", "year"),
    "dim_sector": ("sector_code", "sector_name", "sector_group"),
    "dim_gas": ("gas_code", "gas_name"),
    "dim_icd10_cod": ("icd10_code", "icd10_name"),
    "dim_discharge_type": ("discharge_code", "discharge_name"),
    "fact_population": ("geography_id", "time_id", "population"),
    "fact_emissions": ("geography_id", "time_id", "sector_id", "gas_id", "emissions_kt_co2e"),
    "fact_causes_of_death": ("geography_id", "time_id", "icd10_cod_id", _rate),
    "fact_hospital_discharges": ("geography_id", "time_id", "discharge_type_id"),
}
_grains = {
    "fact_population": ("geography_id", "time_id"),
    "fact_emissions": ("geography_id", "time_id", "sector_id", "gas_id"),
    "fact_causes_of_death": ("geography_id", "time_id", "icd10_cod_id"),
    "fact_hospital_discharges": ("geography_id", "time_id", "discharge_type_id"),
}
_keys = {
    "geography_id": "dim_geography",
    "time_id": "dim_time",
    "sector_id": "dim_sector",
    "gas_id": "dim_gas",
    "icd10_cod_id": "dim_icd10_cod",
    "discharge_type_id": "dim_discharge_type",
}


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def _stats(source: str, table: str, stats: dict[str, str]) -> str:
    return _union(
        f"SELECT '{source}' AS source, '{stat}' AS stat, CAST({expr} AS DOUBLE) AS value FROM {table}"
        for stat, expr in stats.items()
    )


def _cards(table: str, cards: dict[str, str]) -> str:
    return _union(f"SELECT '{card}' AS card, CAST({expr} AS DOUBLE) AS value FROM {table}" for card, expr in cards.items())


_sheets = {"Fossil CO2 AR5": "CO2", "CH4_AR5": "GWP_100_AR5_CH4", "N2O_AR5": "GWP_100_AR5_N2O"}
_sheet_stats = ",\n".join(
    f"sheet{i} AS (SELECT COUNT(*) FILTER (WHERE year IN (SELECT year FROM last_years)) AS cells, "
    f"COUNT(DISTINCT nuts_id || '|' || sector) * (SELECT COUNT(*) FROM last_years) AS slots "
    f"FROM fx_emissions WHERE gas = '{gas}')"
    for i, gas in enumerate(_sheets.values())
)
_kt = "emissions_kt_co2e"
_map, _health = "total_emissions_kt", "cod_copd_rate"


def _round2(x: str) -> str:
    return f"round_even({x} * 100.0::DOUBLE, 0) / 100.0::DOUBLE"


ORACLES = {
    # ingest
    "tidy_wide": f"""{_fx} SELECT frequency AS freq, unit_code AS unit, sex, age_group AS age, icd10_group AS icd10,
        nuts_id, year, {_rate} FROM fx_cells""",
    "ingest_causes": f"{_fx} SELECT * EXCLUDE filled FROM fx_cells WHERE {_rate} IS NOT NULL",
    "ingest_causes_level2": f"{_fx} SELECT * EXCLUDE filled FROM fx_cells WHERE {_rate} IS NOT NULL AND {_level2}",
    "ingest_discharges": f"""{_fx} SELECT nuts_id, year, frequency, indicator, unit_code || '_' || src_ord AS unit_code, sex,
        age_group, icd10_group, discharges FROM fx_discharges WHERE discharges IS NOT NULL""",
    "ingest_population": f"{_fx} SELECT geo, year, population FROM fx_population",
    "ingest_population_long": f"{_fx} SELECT geo, year, population FROM fx_population WHERE year BETWEEN 2000 AND 2024",
    "ingest_population_flagged": f"{_fx} SELECT geo, year, population FROM fx_population WHERE year BETWEEN 2000 AND 2024",
    "ingest_emissions": f"""{_fx} SELECT nuts_id, nuts_label, country_iso, country_name, year,
        CASE WHEN gas = 'CO2' THEN 'fossil_co2' ELSE gas END AS gas, sector, sector_group, {_kt}
        FROM fx_emissions""",
    "population_coverage": f"""{_fx}
        SELECT 0 AS position, 'interface' AS candidate, MIN(year) AS min_year, MAX(year) AS max_year,
          COUNT(DISTINCT CASE WHEN length(geo) = 4 THEN geo END) AS n_level2
        FROM fx_population WHERE year BETWEEN 2000 AND 2024
        UNION ALL SELECT 1, 'file', MIN(year), MAX(year), COUNT(DISTINCT CASE WHEN length(geo) = 4 THEN geo END)
        FROM fx_population""",
    # curated
    "emissions_wide": f"{_wide} SELECT * FROM emissions_wide",
    "causes_wide": f"{_wide} SELECT * FROM causes_wide",
    "discharges_wide": f"{_wide} SELECT * FROM discharges_wide",
    "curated": f"{_curated} SELECT * FROM curated",
    "curated_all_levels": f"{_curated} SELECT * FROM curated_all",
    "curated_window": f"{_curated} SELECT * FROM curated WHERE year BETWEEN 1996 AND 2000",
    "curated_preview": f"{_curated} SELECT * FROM curated ORDER BY nuts_id, year LIMIT 5",
    # star
    "region_universe": f"""{_fx}
        SELECT nuts_id, MIN(nuts_label) AS nuts_label, MIN(country_iso) AS country_iso, MIN(country_name) AS country_name
        FROM (SELECT nuts_id, nuts_label, country_iso, country_name FROM fx_emissions
              UNION SELECT nuts_id, NULL, NULL, NULL FROM fx_causes
              UNION SELECT nuts_id, NULL, NULL, NULL FROM fx_discharges
              UNION SELECT geo, NULL, NULL, NULL FROM fx_population) t
        GROUP BY nuts_id""",
    **{
        name: f"{_star} SELECT * FROM {name}"
        for name in (
            "dim_geography",
            "dim_time",
            "dim_sector",
            "dim_gas",
            "dim_icd10_cod",
            "dim_discharge_type",
            "fact_population",
            "fact_emissions",
            "vw_emissions",
            "vw_health_metrics",
            "vw_hospital_discharges",
        )
    },
    "fact_causes": f"{_star} SELECT * FROM fact_causes_of_death",
    "fact_causes_standard": f"""{_star} SELECT geography_id, year AS time_id, icd10_cod_id, {_rate}
        FROM first_causes_standard c JOIN dim_geography g ON g.nuts_id = c.nuts_id
          JOIN dim_icd10_cod ON icd10_code = icd10_group""",
    "fact_discharges": f"{_star} SELECT * FROM fact_hospital_discharges",
    "vw_merged": f"""{_star},
        e AS (SELECT geography_id, time_id, {_sum(_kt)} AS total_emissions_kt,
            {_list(*[_sum(f"CASE WHEN sector_group = '{g}' THEN {_kt} END") + f' AS {g}' for g in GROUPS])}
          FROM fact_emissions JOIN dim_sector USING (sector_id) GROUP BY geography_id, time_id),
        h AS (SELECT geography_id, time_id,
            {_list(*[f"MAX(CASE WHEN icd10_code = '{c}' THEN {_rate} END) AS {n}" for c, n in MORTALITY.items()])}
          FROM fact_causes_of_death JOIN dim_icd10_cod USING (icd10_cod_id) GROUP BY geography_id, time_id)
        SELECT nuts_id, nuts_label, country_iso, country_name, year, population,
          {_list(*[f'coalesce({g}, 0.0) AS emissions_{g}_kt' for g in GROUPS])}, total_emissions_kt,
          {_list(*MORTALITY.values())}
        FROM dim_geography CROSS JOIN dim_time LEFT JOIN fact_population USING (geography_id, time_id)
          LEFT JOIN e USING (geography_id, time_id) LEFT JOIN h USING (geography_id, time_id)""",
    # checks
    "verify_counts": f"{_star} "
    + _union(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in _required),
    "verify_levels": f"""{_star} SELECT nuts_level, {_LEVEL_NAME.format('nuts_level')} AS level_name,
        COUNT(*) AS n_regions FROM dim_geography GROUP BY nuts_level ORDER BY nuts_level""",
    "verify_years": f"{_star} SELECT MIN(year) AS min_year, MAX(year) AS max_year FROM dim_time",
    "verify_orphans": f"{_star} "
    + _union(
        f"SELECT '{f}' AS fact_name, '{k}' AS key_name, COUNT(*) AS n_orphans FROM {f} LEFT JOIN {_keys[k]} d "
        f"ON {f}.{k} = d.{k} WHERE d.{k} IS NULL"
        for f, g in _grains.items()
        for k in g
    ),
    "verify_grain": f"{_star} "
    + _union(
        f"SELECT '{f}' AS fact_name, CAST(coalesce(SUM(n), 0) AS BIGINT) AS n_rows, COUNT(*) AS n_grains, "
        f"CAST(coalesce(SUM(n), 0) AS BIGINT) - COUNT(*) AS n_surplus "
        f"FROM (SELECT COUNT(*) AS n FROM {f} GROUP BY {', '.join(g)}) t"
        for f, g in _grains.items()
    ),
    "verify_required": f"{_star} "
    + _union(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS n_missing FROM {t}"
        for t, columns in _required.items()
        for c in columns
    ),
    "verify_lengths": f"{_star} "
    + _union(
        f"SELECT 'dim_geography' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE length({c}) > {n}) "
        f"AS n_too_long FROM dim_geography"
        for c, n in {"nuts_id": 10, "country_iso": 3}.items()
    ),
    # profile
    "profile_source": f"{_fx} "
    + _stats(
        "causes",
        "fx_causes",
        {
            "rows": "COUNT(*)",
            "first_year": "MIN(year)",
            "last_year": "MAX(year)",
            "n_years": "COUNT(DISTINCT year)",
            "geo_codes": "COUNT(DISTINCT nuts_id)",
            "icd10_groups": "COUNT(DISTINCT icd10_group)",
            "level2_codes": "COUNT(DISTINCT CASE WHEN length(nuts_id) = 4 THEN nuts_id END)",
        },
    )
    + "\nUNION ALL "
    + _stats(
        "emissions",
        "fx_emissions",
        {
            "rows": "COUNT(*)",
            "first_year": "MIN(year)",
            "last_year": "MAX(year)",
            "n_years": "COUNT(DISTINCT year)",
            "regions": "COUNT(DISTINCT nuts_id)",
            "countries": "COUNT(DISTINCT country_iso)",
            "sectors": "COUNT(DISTINCT sector)",
        },
    ),
    "profile_sheets": f"{_fx}, "
    + ",\n".join(
        f"raw{i} AS (SELECT DISTINCT CASE WHEN sector = 'Energy' THEN ' ' || lower(nuts_id) ELSE nuts_id END AS code, "
        f"nuts_id, country_iso, sector FROM fx_emissions WHERE gas = '{gas}')"
        for i, gas in enumerate(_sheets.values())
    )
    + " "
    + _union(
        _stats(
            sheet,
            f"raw{i}",
            {
                "rows": "COUNT(*)",
                "regions": "COUNT(DISTINCT code)",
                "countries": "COUNT(DISTINCT CASE WHEN code IS NOT NULL THEN country_iso END)",
                "sectors": "COUNT(DISTINCT CASE WHEN code IS NOT NULL THEN sector END)",
                "first_year": "(SELECT MIN(year) FROM fx_emissions) + 0 * COUNT(*)",
                "last_year": "(SELECT MAX(year) FROM fx_emissions) + 0 * COUNT(*)",
                "n_years": "(SELECT COUNT(DISTINCT year) FROM fx_emissions) + 0 * COUNT(*)",
            },
        )
        for i, sheet in enumerate(_sheets)
    ),
    "profile_missing": f"{_fx}, last_years AS (SELECT DISTINCT year FROM fx_emissions ORDER BY year DESC LIMIT 10), {_sheet_stats} "
    + _union(
        f"SELECT '{sheet}' AS source, 'missing_values' AS stat, CAST(slots - cells AS DOUBLE) AS value FROM sheet{i} "
        f"UNION ALL SELECT '{sheet}', 'missing_pct', "
        f"coalesce(CAST(slots - cells AS DOUBLE) / NULLIF(CAST(slots AS DOUBLE), 0) * 100.0::DOUBLE, 0.0) FROM sheet{i}"
        for i, sheet in enumerate(_sheets)
    ),
    "profile_completeness": f"""{_fx} SELECT year, COUNT(*) FILTER (WHERE filled) AS valid, COUNT(*) AS total,
        CAST(COUNT(*) FILTER (WHERE filled) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0::DOUBLE AS valid_pct
        FROM fx_cells WHERE year IN (SELECT y FROM fx_years ORDER BY y DESC LIMIT 5) GROUP BY year""",
    "profile_population_completeness": f"""{_fx},
        p AS (SELECT * FROM fx_population WHERE length(geo) = 4),
        t AS (SELECT COUNT(DISTINCT geo) AS total FROM p),
        v AS (SELECT y AS year, (SELECT COUNT(*) FROM p WHERE p.year = y) AS valid FROM
          (SELECT DISTINCT year AS y FROM fx_population ORDER BY y DESC LIMIT 5) r)
        SELECT CAST(year AS INT) AS year, valid, total, CAST(valid AS DOUBLE) / CAST(total AS DOUBLE) * 100.0::DOUBLE AS valid_pct
        FROM v CROSS JOIN t""",
    "profile_levels": f"""{_fx} SELECT CAST(length(nuts_id) AS INT) AS code_length, COUNT(*) AS n_rows,
        COUNT(DISTINCT nuts_id) AS n_codes FROM fx_causes GROUP BY 1 ORDER BY 1""",
    "profile_level_names": f"""{_fx} SELECT {_LEVEL_NAME.format(f"({_level('geo')})")} AS level_name,
        2 * COUNT(DISTINCT geo) AS n_rows, COUNT(DISTINCT geo) AS n_codes FROM fx_population GROUP BY 1""",
    "profile_code_sample": f"""{_fx} SELECT nuts_id AS code, CAST(length(nuts_id) AS INT) AS code_length
        FROM (SELECT DISTINCT nuts_id FROM fx_emissions) t
        QUALIFY row_number() OVER (PARTITION BY length(nuts_id) ORDER BY nuts_id) <= 5 ORDER BY 2, 1""",
    "profile_respiratory_codes": f"""{_fx} SELECT DISTINCT icd10_group AS code FROM fx_causes
        WHERE icd10_group LIKE 'J%' OR lower(icd10_group) LIKE '%resp%'""",
    "coverage_overlap": f"{_fx}, {_sets('nuts_id', _level2, ('emissions',))} {_overlaps('COUNT(v) AS n_codes')}",
    "coverage_overlap_level2": f"{_fx}, {_sets('nuts_id', _level2)} {_overlaps('COUNT(v) AS n_codes')}",
    "harmonization_window": f"{_fx}, {_sets('year')} "
    + _overlaps("MIN(v) AS first_year, MAX(v) AS last_year, COUNT(v) AS n_years"),
    # dashboard
    "dash_slice": f"{_dash} SELECT * FROM labelled WHERE year = (SELECT MAX(year) FROM curated)",
    "dash_slice_selected": f"{_dash} SELECT * FROM slice2000 WHERE country_iso IN {_in(COUNTRIES)}",
    "dash_top_bottom": f"""{_dash}
        (SELECT nuts_id, region_label, country_iso, {_health} FROM slice2000
          ORDER BY {_health} DESC NULLS LAST, nuts_id LIMIT 8)
        UNION ALL (SELECT nuts_id, region_label, country_iso, {_health} FROM slice2000
          ORDER BY {_health} ASC NULLS LAST, nuts_id LIMIT 8)""",
    "dash_key_stats": f"""{_dash},
        exact AS (SELECT CAST({_map} AS DECIMAL(28,2)) AS m, {_health} AS h FROM slice2000)
        SELECT 'Mean' AS stat, {_round2(f'(CAST(SUM(m) AS DOUBLE) / COUNT(m))')} AS {_map},
          {_round2(_avg12('h'))} AS {_health} FROM exact
        UNION ALL SELECT 'Min', {_round2('CAST(MIN(m) AS DOUBLE)')}, {_round2('MIN(h)')} FROM exact
        UNION ALL SELECT 'Max', {_round2('CAST(MAX(m) AS DOUBLE)')}, {_round2('MAX(h)')} FROM exact""",
    "dash_comparison": f"""{_dash} SELECT region_label, country_iso, total_emissions_kt, emissions_per_capita_tonnes, {_health}
        FROM slice2000 ORDER BY total_emissions_kt DESC NULLS LAST, nuts_id""",
    "dash_sector_long": f"{_dash} "
    + _union(
        f"SELECT region_label, nuts_id, country_iso, total_emissions_kt, '{g.capitalize()}' AS sector_group, "
        f"emissions_{g}_kt AS emissions_kt FROM slice2000"
        for g in GROUPS
    ),
    "dash_region_options": f"{_dash} SELECT DISTINCT region_display, nuts_id FROM labelled ORDER BY region_display",
    "dash_year_range": f"{_dash} SELECT MIN(year) AS min_year, MAX(year) AS max_year FROM curated",
    "dash_country_options": f"{_dash} SELECT DISTINCT country_iso FROM curated ORDER BY country_iso",
    "geo_features": f"{_fx} SELECT DISTINCT nuts_id, 2 AS level, 'Point' AS shape FROM fx_geo WHERE {_level2}",
    "geo_region_map": f"""{_dash} SELECT nuts_id, region_label, country_iso, {_map}, 'Point' AS shape
        FROM slice2000 WHERE nuts_id IN (SELECT nuts_id FROM fx_geo)""",
    # report queries
    "q1_country_year": f"""{_star}, per_key AS (
          SELECT geography_id, time_id AS year, SUM(CAST({_kt} AS DECIMAL(28,2))) AS kt FROM fact_emissions GROUP BY ALL)
        SELECT country_name, year, CAST(SUM(kt) AS DOUBLE) AS total_emissions_kt
        FROM dim_geography JOIN per_key USING (geography_id) GROUP BY ALL""",
    "q2_resp_rates": f"""{_star}, causes AS (
          SELECT icd10_cod_id, icd10_name FROM dim_icd10_cod WHERE is_respiratory = 1),
        rates AS (SELECT * FROM fact_causes_of_death WHERE time_id = 2000)
        SELECT nuts_label, country_name, icd10_name, {_rate}
        FROM causes JOIN rates USING (icd10_cod_id) JOIN dim_geography USING (geography_id)""",
    "q3_emissions_vs_health": f"""{_star}, emitted AS (
          SELECT geography_id, time_id, {_sum(_kt)} AS total_emissions_kt FROM fact_emissions
          WHERE time_id >= 1996 AND time_id <= 2000 GROUP BY ALL),
        mortality AS (
          SELECT geography_id, time_id, {_rate} AS cod_all_resp_rate
          FROM fact_causes_of_death JOIN dim_icd10_cod USING (icd10_cod_id) WHERE icd10_code = 'J')
        SELECT nuts_id, nuts_label, time_id AS year, total_emissions_kt, cod_all_resp_rate
        FROM dim_geography JOIN emitted USING (geography_id) LEFT JOIN mortality USING (geography_id, time_id)""",
    "q4_per_capita_sector": f"""{_star}, in_year AS (
          SELECT sector_id, SUM(CAST({_kt} AS DECIMAL(28,2))) AS kt, SUM(population) AS people
          FROM fact_emissions JOIN fact_population USING (geography_id, time_id) WHERE time_id = 2000 GROUP BY sector_id)
        SELECT sector_name, sector_group, CAST(SUM(kt) AS DOUBLE) AS total_emissions_kt,
          CAST(SUM(people) AS BIGINT) AS total_population,
          CAST(SUM(kt) AS DOUBLE) * 1000.0::DOUBLE / CAST(SUM(people) AS DOUBLE) AS emissions_per_capita_tonnes
        FROM in_year JOIN dim_sector USING (sector_id) GROUP BY ALL""",
    "q5_discharge_rates": f"""{_star}, kinds AS (
          SELECT discharge_type_id, discharge_name FROM dim_discharge_type WHERE is_respiratory = 1),
        counted AS (SELECT * FROM fact_hospital_discharges WHERE time_id = 2000)
        SELECT country_name, discharge_name, SUM(discharge_count) AS total_discharges,
          {_avg('discharge_rate_per_100k')} AS avg_rate_per_100k
        FROM counted JOIN kinds USING (discharge_type_id) JOIN dim_geography USING (geography_id) GROUP BY ALL""",
    # report pages
    "bi_emissions_country": f"""{_star} SELECT country_name, {_sum(_kt)} AS total_emissions_kt
        FROM vw_emissions WHERE nuts_level = 0 GROUP BY country_name""",
    "bi_emissions_year": f"""{_star} SELECT year, {_sum(_kt)} AS total_emissions_kt
        FROM vw_emissions WHERE nuts_level = 0 GROUP BY year""",
    "bi_emissions_trend_top5": f"""{_star} SELECT country_name, year, {_sum(_kt)} AS total_emissions_kt
        FROM vw_emissions WHERE nuts_level = 0 AND country_name IN (
          SELECT country_name FROM vw_emissions WHERE nuts_level = 0 GROUP BY country_name
          ORDER BY {_sum(_kt)} DESC, country_name LIMIT 5)
        GROUP BY country_name, year""",
    "bi_emissions_sector_year": f"""{_star} SELECT year, sector_group, {_sum(_kt)} AS total_emissions_kt
        FROM vw_emissions GROUP BY year, sector_group ORDER BY year, total_emissions_kt DESC""",
    "bi_gas_share": f"""{_star} SELECT gas_name, {_sum(_kt)} AS total_emissions_kt,
          {_sum(_kt)} / (SELECT {_sum(_kt)} FROM vw_emissions) * 100.0::DOUBLE AS share_pct
        FROM vw_emissions GROUP BY gas_name""",
    "bi_top10_emitters": f"""{_star} SELECT nuts_label, country_name, {_sum(_kt)} AS total_emissions_kt
        FROM vw_emissions GROUP BY nuts_label, country_name
        ORDER BY total_emissions_kt DESC, nuts_label, country_name LIMIT 10""",
    "bi_top5_emitting_countries": f"""{_star} SELECT country_name, {_sum(_kt)} AS total_emissions_kt
        FROM vw_emissions WHERE nuts_level = 0 GROUP BY country_name
        ORDER BY total_emissions_kt DESC, country_name LIMIT 5""",
    "bi_emissions_sliced": f"""{_star} SELECT year, sector_group, {_sum(_kt)} AS total_emissions_kt
        FROM vw_emissions WHERE year BETWEEN 1998 AND 2001 AND sector_group IN ('energy', 'transport')
          AND gas_name = 'Methane' AND nuts_level IN (1, 2)
        GROUP BY year, sector_group ORDER BY year, total_emissions_kt DESC""",
    "bi_death_rate_country": f"""{_star} SELECT country_name, {_avg(_rate)} AS avg_death_rate
        FROM vw_health_metrics WHERE is_respiratory = 1 AND nuts_level = 0 GROUP BY country_name""",
    "bi_death_rate_year": f"""{_star} SELECT year, {_avg(_rate)} AS avg_death_rate
        FROM vw_health_metrics WHERE is_respiratory = 1 AND nuts_level = 0 GROUP BY year""",
    "bi_death_rate_trend": f"""{_star} SELECT country_name, year, {_avg(_rate)} AS avg_death_rate
        FROM vw_health_metrics WHERE is_respiratory = 1 AND nuts_level = 0 AND country_name IN (
          SELECT country_name FROM vw_health_metrics WHERE is_respiratory = 1 AND nuts_level = 0
          GROUP BY country_name ORDER BY {_avg(_rate)} DESC, country_name LIMIT 5)
        GROUP BY country_name, year""",
    "bi_rate_by_category": f"""{_star} SELECT year, icd10_category, icd10_name, {_avg(_rate)} AS avg_death_rate
        FROM vw_health_metrics WHERE is_respiratory = 1 AND nuts_level = 0
        GROUP BY year, icd10_category, icd10_name""",
    "bi_discharge_rate_country": f"""{_star} SELECT country_name, {_avg('discharge_rate_per_100k')} AS avg_discharge_rate
        FROM vw_hospital_discharges WHERE is_respiratory = 1 AND nuts_level = 0
        GROUP BY country_name ORDER BY avg_discharge_rate DESC""",
    "bi_top10_death_rate": f"""{_star} SELECT nuts_label, country_name, {_avg(_rate)} AS avg_death_rate
        FROM vw_health_metrics WHERE is_respiratory = 1 GROUP BY nuts_label, country_name
        ORDER BY avg_death_rate DESC, nuts_label, country_name LIMIT 10""",
    "bi_top5_death_rate_countries": f"""{_star} SELECT country_name, {_avg(_rate)} AS avg_death_rate
        FROM vw_health_metrics WHERE is_respiratory = 1 AND nuts_level = 0 GROUP BY country_name
        ORDER BY avg_death_rate DESC, country_name LIMIT 5""",
    "bi_cards": f"{_star} "
    + _cards(
        "vw_emissions",
        {
            "total_emissions_kt": _sum(_kt),
            "n_regions": "COUNT(DISTINCT nuts_id)",
            "emissions_first_year": "MIN(year)",
            "emissions_last_year": "MAX(year)",
        },
    )
    + "\nUNION ALL "
    + _cards(
        "vw_health_metrics",
        {
            "avg_resp_death_rate": _avg(f"CASE WHEN is_respiratory = 1 THEN {_rate} END"),
            "health_first_year": "MIN(year)",
            "health_last_year": "MAX(year)",
        },
    ),
    "bi_measures": f"{_star} "
    + _cards(
        "vw_emissions",
        {
            "total_emissions": _sum(_kt),
            "emissions_per_capita": f"coalesce({_sum(_kt)} / (SELECT NULLIF(CAST(SUM(population) AS DOUBLE), 0) FROM fact_population), 0)",
        },
    )
    + "\nUNION ALL "
    + _cards(
        "vw_health_metrics", {"avg_respiratory_death_rate": _avg(f"CASE WHEN is_respiratory = 1 THEN {_rate} END")}
    )
    + "\nUNION ALL "
    + _cards(
        "vw_hospital_discharges",
        {
            "total_hospital_discharges": "SUM(CASE WHEN is_respiratory = 1 THEN discharge_count END)",
            "avg_hospital_discharge_rate": _avg("CASE WHEN is_respiratory = 1 THEN discharge_rate_per_100k END"),
        },
    ),
    # correlation page
    "corr_data": f"{_pairs} SELECT * FROM pairs",
    "corr_matrix": f"""{_pairs} SELECT country_name, {_sum('total_emissions')} AS total_emissions,
          {_avg12('avg_death_rate')} AS avg_death_rate
        FROM pairs GROUP BY country_name""",
    "corr_pearson": f"{_pairs} SELECT country_name, {_pearson} FROM pairs GROUP BY country_name",
    "corr_pearson_overall": f"{_pairs} SELECT {_pearson} FROM pairs",
    "corr_by_sector": f"{_pairs} SELECT * FROM sector_pairs",
    "corr_pearson_sector": f"{_pairs} SELECT sector_group, {_pearson} FROM sector_pairs GROUP BY sector_group",
    "corr_timeseries": f"""{_pairs} SELECT * FROM
          (SELECT year, {_sum(_kt)} AS total_emissions FROM vw_emissions
           WHERE nuts_level = 0 AND year BETWEEN 1998 AND 2001 GROUP BY year) e
        NATURAL JOIN (SELECT year, {_avg(_rate)} AS avg_death_rate FROM vw_health_metrics
           WHERE nuts_level = 0 AND is_respiratory = 1 AND year BETWEEN 1998 AND 2001 GROUP BY year) h""",
    "corr_regional_top10": f"""{_pairs} SELECT nuts_label, country_name, {_sum('total_emissions')} AS total_emissions,
          {_avg12('avg_death_rate')} AS avg_death_rate
        FROM pairs GROUP BY nuts_label, country_name ORDER BY total_emissions DESC, nuts_label, country_name LIMIT 10""",
    "lag_analysis": f"{_pairs} SELECT * FROM lagged",
    "lag_by_year": f"""{_pairs} SELECT year, {_sum('emissions')} AS emissions,
          {_avg12('death_rate_prev_year')} AS death_rate_prev_year
        FROM lagged GROUP BY year""",
}

# Queries over files have the results of the queries over tables.
ORACLES |= {
    "scan_wide_tsv": ORACLES["ingest_causes"],
    "scan_sdmx_csv": ORACLES["ingest_population_long"],
    "scan_sheets": ORACLES["ingest_emissions"],
    "scan_geojson": ORACLES["geo_features"],
    "load_or_build_population": ORACLES["ingest_population"],
    "star_stamped": f"SELECT table_name, n_rows, n_rows AS n_stamped FROM ({ORACLES['verify_counts']}) t",
}

# Naming rules as one CASE each, on codes dealt to the parts.
_CODES = (
    "A-R_V-Y A-T_Z a-t_z A-T_Z_XNB J J_OTH J09-J11 J00-J11 J12-J18 J12-J18_OTH J20-J22 J40-J44 J40-J44_J47 J45_J46 J60-J99"
    " A00-A08 A09 A15-A19_B90 A40_A41 B15-B19 B20-B24 A B C C_OTH C00-D48 D05 D50-D89 E10-E14 F00-F99 G20 H25-H26 H60-H95 H5 H"
    " H96 I I20-I25 I20-I25_OTH I60-I69_OTH I30 K70 L M N O P Q R S T V X60 Y Z38 U UPRESPIR_OTH 1"
).split()
_GASES = "CO2 carbon GWP_100_AR5_CH4 methane N2O nitrous F-GAS f_gas GWP_100_AR5_F-gases fluorinated SF6 xyz".split()


def _dealt(codes: list[str]) -> str:
    return f"SELECT ({codes!r})[1 + p_partkey % {len(codes)}] AS code, COUNT(*) AS n_rows FROM part GROUP BY 1"


ORACLES |= {
    "icd10_rules": f"""WITH c AS ({_dealt(_CODES)}),
        p AS (SELECT *, regexp_replace(code, '_OTH$', '') AS stem, code[1] AS l,
          CASE WHEN code LIKE '%\\_OTH' ESCAPE '\\' THEN ' (other)' ELSE '' END AS m FROM c),
        h AS (SELECT *, CASE WHEN l = 'H' THEN TRY_CAST(nullif(regexp_extract(stem[2:3], '^[0-9]{{1,2}}$'), '') AS INT) END AS h FROM p),
        n AS (SELECT *, CASE
            WHEN code = 'A-R_V-Y' THEN 'All causes of death'
            WHEN upper(code) = 'A-T_Z' THEN 'All diseases and health factors (A-T, Z)'
            WHEN starts_with(code, 'A-T_Z') THEN 'All diseases and health factors (A-T, Z) - ' || substr(code, 7)
            WHEN code = 'J' THEN 'All respiratory diseases'
            WHEN code = 'J_OTH' THEN 'Other respiratory conditions'
            WHEN stem = 'J00-J11' THEN 'Acute upper respiratory infections' || m
            WHEN stem = 'J12-J18' THEN 'Pneumonia' || m
            WHEN stem = 'J20-J22' THEN 'Other acute lower respiratory infections' || m
            WHEN stem IN ('J40-J44', 'J40-J44_J47') THEN 'Chronic lower respiratory diseases (COPD)' || m
            WHEN stem = 'J45_J46' THEN 'Asthma' || m
            WHEN stem = 'J60-J99' THEN 'Other respiratory diseases' || m
            WHEN starts_with(code, 'A00-A08') THEN 'Intestinal infectious diseases' || m
            WHEN starts_with(code, 'A09') THEN 'Other gastroenteritis and colitis' || m
            WHEN l IN ('A', 'B') AND contains(code, 'A15-A19') THEN 'Tuberculosis' || m
            WHEN starts_with(code, 'A40_A41') THEN 'Sepsis' || m
            WHEN l IN ('A', 'B') AND contains(code, 'B15-B19') THEN 'Viral hepatitis' || m
            WHEN starts_with(code, 'B20-B24') THEN 'HIV disease' || m
            WHEN starts_with(code, 'I20-I25') THEN 'Ischaemic heart diseases' || m
            WHEN starts_with(code, 'I60-I69') THEN 'Cerebrovascular diseases' || m
            WHEN stem = 'C' THEN 'All neoplasms' WHEN stem = 'I' THEN 'All circulatory diseases'
            WHEN h < 60 THEN 'Diseases of eye and adnexa' || m
            WHEN h <= 95 THEN 'Diseases of ear and mastoid process' || m
            WHEN l IN ('J', 'A', 'B', 'C', 'D', 'I', 'K', 'L', 'M', 'N', 'O', 'P', 'Q', 'R', 'S', 'T', 'Z') THEN
              CASE WHEN l = 'J' THEN 'Respiratory disease' WHEN l IN ('A', 'B') THEN 'Infectious disease'
                WHEN l IN ('C', 'D') THEN 'Neoplasm' WHEN l = 'I' THEN 'Circulatory disease'
                WHEN l = 'K' THEN 'Digestive disease' WHEN l = 'L' THEN 'Diseases of skin and subcutaneous tissue'
                WHEN l = 'M' THEN 'Diseases of musculoskeletal system' WHEN l = 'N' THEN 'Diseases of genitourinary system'
                WHEN l = 'O' THEN 'Pregnancy, childbirth and puerperium'
                WHEN l = 'P' THEN 'Conditions originating in perinatal period' WHEN l = 'Q' THEN 'Congenital malformations'
                WHEN l = 'R' THEN 'Symptoms, signs and abnormal findings'
                WHEN l IN ('S', 'T') THEN 'Injury, poisoning and external causes'
                ELSE 'Factors influencing health status' END || ' (' || code || ')'
            ELSE code END AS name,
          CASE WHEN code = 'A-R_V-Y' THEN 'all_causes' WHEN starts_with(upper(code), 'A-T_Z') THEN 'all_conditions'
            WHEN stem = 'J' THEN 'all_respiratory' WHEN l = 'D' AND length(stem) <= 3 THEN 'neoplasms' WHEN l = 'D' THEN 'blood_immune'
            WHEN h < 60 THEN 'eye_adnexa' WHEN h <= 95 THEN 'ear_mastoid' WHEN l = 'J' THEN 'respiratory'
            WHEN l IN ('A', 'B') THEN 'infectious' WHEN l = 'C' THEN 'neoplasms' WHEN l = 'E' THEN 'endocrine_metabolic'
            WHEN l = 'F' THEN 'mental_behavioural' WHEN l = 'G' THEN 'nervous_system' WHEN l = 'I' THEN 'circulatory'
            WHEN l = 'K' THEN 'digestive' WHEN l = 'L' THEN 'skin_subcutaneous' WHEN l = 'M' THEN 'musculoskeletal'
            WHEN l = 'N' THEN 'genitourinary' WHEN l = 'O' THEN 'pregnancy_childbirth' WHEN l = 'P' THEN 'perinatal'
            WHEN l = 'Q' THEN 'congenital' WHEN l = 'R' THEN 'symptoms_signs' WHEN l IN ('S', 'T') THEN 'injury_poisoning'
            WHEN l = 'Z' THEN 'health_factors' WHEN l IN ('V', 'W', 'X', 'Y') THEN 'external_causes' END AS category FROM h)
        SELECT code, n_rows, name, category, CAST(l = 'J' AS INT) AS is_respiratory,
          coalesce(name || ' (' || replace(category, '_', ' ') || ')', name) AS description FROM n""",
    "gas_rules": f"""WITH c AS ({_dealt(_GASES)}),
        k AS (SELECT *, CASE WHEN upper(code) LIKE '%CH4%' OR upper(code) LIKE '%METHANE%' THEN 1
            WHEN upper(code) LIKE '%N2O%' OR upper(code) LIKE '%NITROUS%' THEN 2
            WHEN regexp_matches(upper(code), 'F[-_]GAS|FLUORINATED') THEN 3
            WHEN upper(code) LIKE '%CO2%' OR upper(code) LIKE '%CARBON%' THEN 4 END AS k FROM c)
        SELECT code, n_rows, coalesce(['Methane', 'Nitrous Oxide', 'Fluorinated Gases', 'Carbon Dioxide'][k], code) AS gas_name,
          ['CH₄', 'N₂O', 'F-gases', 'CO₂'][k] AS gas_formula, CAST([28, 265, 1000, 1][k] AS DOUBLE) AS gwp_ar5 FROM k""",
}

"""Column layouts of the tidy, curated and star tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, type_) for name, type_ in columns.items()])


_TEXT, _INT, _DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()

EMISSIONS = _schema(
    nuts_id=_TEXT,
    nuts_label=_TEXT,
    country_iso=_TEXT,
    country_name=_TEXT,
    year=_INT,
    gas=_TEXT,
    sector=_TEXT,
    sector_group=_TEXT,
    emissions_kt_co2e=_DOUBLE,
)
CAUSES = _schema(
    nuts_id=_TEXT,
    year=_INT,
    frequency=_TEXT,
    unit_code=_TEXT,
    sex=_TEXT,
    age_group=_TEXT,
    icd10_group=_TEXT,
    age_standardised_rate_per_100k=_DOUBLE,
)
DISCHARGES = _schema(
    nuts_id=_TEXT,
    year=_INT,
    frequency=_TEXT,
    indicator=_TEXT,
    unit_code=_TEXT,
    sex=_TEXT,
    age_group=_TEXT,
    icd10_group=_TEXT,
    discharges=_DOUBLE,
)
POPULATION = _schema(geo=_TEXT, year=_INT, population=_DOUBLE)

# Optional extra column of a tidy table: the position of the row in its source. Steps that keep
# "the first row" order by it.
SOURCE_ORDER = "src_ord"

# Sector -> sector group.
SECTOR_GROUPS = {
    "Agriculture": "agriculture",
    "Buildings": "buildings",
    "Energy": "energy",
    "Industry": "industry",
    "Transport": "transport",
    "Dom_Avi": "transport",
    "Dom_Ship": "transport",
    "Waste": "waste",
}
OTHER_SECTOR_GROUP = "other"
SECTOR_GROUP_NAMES = ("agriculture", "buildings", "energy", "industry", "other", "transport", "waste")

# Emission sheet -> gas label.
EMISSION_SHEETS = {
    "Fossil CO2 AR5": "fossil_co2",
    "CH4_AR5": "ch4",
    "N2O_AR5": "n2o",
    "F-gas AR5": "f_gas",
}

# ICD-10 group -> curated metric.
MORTALITY_METRICS = {
    "J": "cod_all_resp_rate",
    "J09-J11": "cod_influenza_rate",
    "J12-J18": "cod_pneumonia_rate",
    "J40-J44_J47": "cod_copd_rate",
    "J45_J46": "cod_asthma_rate",
}
DISCHARGE_METRICS = {
    "J": "discharge_all_resp",
    "J00-J11": "discharge_upper_resp",
    "J12-J18": "discharge_pneumonia",
    "J20-J22": "discharge_bronchitis",
    "J40-J44_J47": "discharge_copd",
    "J45_J46": "discharge_asthma",
    "J60-J99": "discharge_other_resp",
}

# Grain of each fact, in the star's own keys.
FACT_GRAINS = {
    "fact_population": ("geography_id", "time_id"),
    "fact_emissions": ("geography_id", "time_id", "sector_id", "gas_id"),
    "fact_causes_of_death": ("geography_id", "time_id", "icd10_cod_id"),
    "fact_hospital_discharges": ("geography_id", "time_id", "discharge_type_id"),
}
# Foreign key column -> dimension table.
FOREIGN_KEYS = {
    "geography_id": "dim_geography",
    "time_id": "dim_time",
    "sector_id": "dim_sector",
    "gas_id": "dim_gas",
    "icd10_cod_id": "dim_icd10_cod",
    "discharge_type_id": "dim_discharge_type",
}
# Columns declared NOT NULL, besides the keys of the grain.
REQUIRED_COLUMNS = {
    "dim_geography": ("nuts_id", "nuts_level", "country_iso"),
    "dim_time": ("time_id", "year"),
    "dim_sector": ("sector_code", "sector_name", "sector_group"),
    "dim_gas": ("gas_code", "gas_name"),
    "dim_icd10_cod": ("icd10_code", "icd10_name"),
    "dim_discharge_type": ("discharge_code", "discharge_name"),
    "fact_population": ("population",),
    "fact_emissions": ("emissions_kt_co2e",),
    "fact_causes_of_death": ("age_standardised_rate_per_100k",),
    "fact_hospital_discharges": (),
}
DIMENSIONS = tuple(t for t in REQUIRED_COLUMNS if t.startswith("dim_"))
FACTS = tuple(FACT_GRAINS)

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from arealens.operators import keep_first
from arealens.plans import dashboard, profile, star, tidy
from arealens.schemas import SOURCE_ORDER
from arealens.sources import (
    choose_by_coverage,
    load_or_build,
    read_features,
    read_sdmx_csv,
    read_sheet,
    read_sheets,
    read_table,
    read_wide_tsv,
    write_table,
)
from tests.conftest import rows

CAUSES_TSV = """freq,unit,sex,age,icd10,geo\\TIME_PERIOD\t2010 \t2011 \t2012
A,RT,T,TOTAL,J,AT11\t61.2 \t: \t58.9 b
A,RT,F,TOTAL,J,AT11\t50.0 \t51.5 \t52.0
A,RT,T,TOTAL,J45_J46,at12 \t1.4 \t1.3 \t12d
A,RT,T,TOTAL,J,AT\t55.1 \t54.0 \t53.2
"""
DISCHARGES_TSV = """freq,age,indic_he,unit,sex,icd10,geo\\TIME_PERIOD\t2010 \t2011
A,TOTAL,INPAT,NR,T,J,AT11\t3200 \t3105
A,TOTAL,INPAT,NR,T,J20-J22,AT11\t: \t410
"""
POPULATION_TSV = """freq,unit,sex,age,geo\\TIME_PERIOD\t2010 \t2011
A,NR,T,TOTAL,AT11\t283697 \t284581
A,NR,F,TOTAL,AT11\t144000 \t144500
"""
HEADER = "Substance,ISO,Country,NUTS 2,NUTS 2 desc,Sector,Y_1990,Y_1991"
SHEET = f"""Content:,Emissions by sector
Compound:,CO2
Start year:,1990
End year:,1991
,
{HEADER}
CO2,AUT,Austria,AT11,Burgenland,Energy,10.5,
,aut,Austria, at ,,Dom_Avi,1.0,1.1
CO2,AUT,Austria,,,Energy,3.0,4.0
CO2,AUT,Austria,AT12,Niederösterreich,Fishing,0.1,0.2
"""


@pytest.fixture
def write(tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return put


def test_wide_tsv_keeps_its_header(spark, write):
    df = read_wide_tsv(spark, write("a.tsv", CAUSES_TSV))
    assert df.columns == ["freq,unit,sex,age,icd10,geo\\TIME_PERIOD", "2010 ", "2011 ", "2012", SOURCE_ORDER]


def test_causes(spark, write):
    got = tidy.causes_of_death(read_wide_tsv(spark, write("a.tsv", CAUSES_TSV)))
    assert got.columns[:-1] == [
        "nuts_id",
        "year",
        "frequency",
        "unit_code",
        "sex",
        "age_group",
        "icd10_group",
        "age_standardised_rate_per_100k",
    ]
    data = rows(got.drop(SOURCE_ORDER), "nuts_id", "icd10_group", "sex", "year")
    assert len(data) == 9
    assert {r["nuts_id"] for r in data} == {"AT", "AT11", "AT12"}
    assert {(r["year"], r["age_standardised_rate_per_100k"]) for r in data if r["nuts_id"] == "AT12"} == {
        (2010, 1.4),
        (2011, 1.3),
    }
    assert dict(got.dtypes)["year"] == "int"


def test_tidy_keeps_missing_cells_and_filters_levels(spark, write):
    df = read_wide_tsv(spark, write("a.tsv", CAUSES_TSV))
    long = tidy.tidy_wide(df, "v")
    assert long.count() == 12 and long.filter("v IS NULL").count() == 3
    assert {r["nuts_id"] for r in rows(tidy.tidy_wide(df, "v", level_only=2))} == {"AT11", "AT12"}
    assert {r["nuts_id"] for r in rows(tidy.tidy_wide(df, "v", level_only=0))} == {"AT"}


def test_source_order_follows_the_file(spark, tmp_path):
    lines = ["freq,unit,sex,age,icd10,geo\\TIME_PERIOD\t2010 "]
    lines += [f"A,RT,T,TOTAL,J,R{i:05d}\t{i} " for i in range(20000)]
    path = tmp_path / "big.tsv"
    path.write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 64 * 1024)
    try:
        df = read_wide_tsv(spark, str(path))
        assert df.rdd.getNumPartitions() > 3
        codes = [r[0] for r in tidy.causes_of_death(df).orderBy(SOURCE_ORDER).select("nuts_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert codes == [f"R{i:05d}" for i in range(20000)]
    kept = keep_first(tidy.causes_of_death(df), ["nuts_id", "year", "icd10_group"], "age_standardised_rate_per_100k")
    assert "SortAggregate" not in kept._jdf.queryExecution().executedPlan().toString()


def test_source_order_over_several_files(spark, tmp_path):
    head = "freq,unit,sex,age,icd10,geo\\TIME_PERIOD\t2010 \n"
    for part in "ba":
        text = head + "".join(f"A,RT,T,TOTAL,J,{part.upper()}{i:03d}\t{i} \n" for i in range(50))
        (tmp_path / f"{part}.tsv").write_text(text)
    long = tidy.causes_of_death(read_wide_tsv(spark, str(tmp_path)))
    codes = [r[0] for r in long.orderBy(SOURCE_ORDER).select("nuts_id").collect()]
    assert codes == [f"{p}{i:03d}" for p in "AB" for i in range(50)]
    first = keep_first(long, ["year"], "age_standardised_rate_per_100k")
    assert [tuple(r) for r in first.collect()] == [(2010, 0.0)]


def test_short_dimension_rows_give_nulls(spark):
    df = spark.createDataFrame([("A,RT", "1"), ("A,RT,AT11", "2")], "`freq,unit,geo` string, `2010` string")
    assert [(r["nuts_id"], r["v"]) for r in rows(tidy.tidy_wide(df, "v"))] == [("AT11", 2.0)]


def test_geo_column_discovery():
    assert tidy.find_geo_column(["freq", "geo\\TIME_PERIOD"]) == "geo\\TIME_PERIOD"
    assert tidy.find_geo_column(["geo", "x"]) == "geo"
    with pytest.raises(ValueError):
        tidy.find_geo_column(["freq"])


def test_discharges(spark, write):
    data = rows(tidy.hospital_discharges(read_wide_tsv(spark, write("a.tsv", DISCHARGES_TSV))), "icd10_group", "year")
    assert [(r["icd10_group"], r["year"], r["indicator"], r["discharges"]) for r in data] == [
        ("J", 2010, "INPAT", 3200.0),
        ("J", 2011, "INPAT", 3105.0),
        ("J20-J22", 2011, "INPAT", 410.0),
    ]


def test_population_layouts_agree(spark, write):
    wide = tidy.population(read_wide_tsv(spark, write("p.tsv", POPULATION_TSV)))
    long = tidy.population(
        read_sdmx_csv(
            spark,
            write(
                "p.csv",
                "freq,unit,sex,age,geo,TIME_PERIOD,OBS_VALUE\nA,NR,T,TOTAL,at11,2010,283697\n"
                "A,NR,T,TOTAL,AT11,2011,284581\nA,NR,T,TOTAL,AT11,1999,1\nA,NR,T,TOTAL,AT11,2012,:\n"
                "A,NR,F,TOTAL,AT11,2010,144000\n",
            ),
        )
    )
    flagged = tidy.population(
        read_sdmx_csv(
            spark,
            write(
                "f.csv",
                "freq,sex,unit,age,geo\\TIME_PERIOD,2010_value,2010_flag,2011_value,2011_flag,1999_value\n"
                "A,T,NR,TOTAL,AT11,283697,b,284581,,1\nA,F,NR,TOTAL,AT11,144000,,144500,,1\n",
            ),
        )
    )
    expected = [
        {"geo": "AT11", "year": 2010, "population": 283697.0},
        {"geo": "AT11", "year": 2011, "population": 284581.0},
    ]
    for df in (wide, long, flagged):
        assert rows(df.drop(SOURCE_ORDER), "year") == expected


def test_stratum_is_tested_only_where_present(spark):
    df = spark.createDataFrame([("AT11", "5"), ("AT12", "6")], "geo string, `2010` string")
    df = df.withColumnRenamed("geo", "geo\\TIME_PERIOD")
    assert tidy.population(df).count() == 2


def test_sheet_header_is_found_below_the_preamble(spark, write):
    df = read_sheet(spark, write("s.csv", SHEET))
    assert df.columns == HEADER.split(",") + [SOURCE_ORDER]
    assert df.count() == 4
    with pytest.raises(ValueError):
        read_sheet(spark, write("t.csv", "a,b\n1,2\n"))


def test_emissions(spark, write):
    other = SHEET.replace("CO2,AUT,Austria,AT11", "CH4,AUT,Austria,AT11").replace("10.5", "2.5")
    sheets = read_sheets(spark, {"Fossil CO2 AR5": write("a.csv", SHEET), "Special": write("b.csv", other)})
    data = rows(tidy.emissions(sheets).drop(SOURCE_ORDER), "gas", "nuts_id", "year")
    first = [(r["nuts_id"], r["gas"], r["sector_group"], r["year"], r["emissions_kt_co2e"]) for r in data]
    assert first == [
        ("AT11", "CH4", "energy", 1990, 2.5),
        ("AT11", "CO2", "energy", 1990, 10.5),
        ("AT12", "CO2", "other", 1990, 0.1),
        ("AT12", "CO2", "other", 1990, 0.1),
        ("AT12", "CO2", "other", 1991, 0.2),
        ("AT12", "CO2", "other", 1991, 0.2),
        ("AT", "Special", "transport", 1990, 1.0),
        ("AT", "Special", "transport", 1991, 1.1),
        ("AT", "fossil_co2", "transport", 1990, 1.0),
        ("AT", "fossil_co2", "transport", 1991, 1.1),
    ]
    assert {r["country_iso"] for r in data} == {"AUT"}
    assert [r["nuts_label"] for r in data if r["nuts_id"] == "AT"] == [None] * 4


def test_emission_options(spark, write):
    sheets = read_sheets(spark, {"CH4_AR5": write("a.csv", SHEET), "N2O_AR5": write("b.csv", SHEET)})
    only = tidy.emissions(sheets, {"Energy": "power"}, level_only=2, wanted=["N2O_AR5"])
    assert {(r["nuts_id"], r["sector_group"]) for r in rows(only)} == {("AT11", "power"), ("AT12", "other")}
    assert only.count() == 3
    with pytest.raises(ValueError):
        tidy.emissions({})


def test_sheet_order_decides_the_first_row(spark, write):
    renamed = SHEET.replace("Burgenland", "Elsewhere")
    # The second sheet sorts first by file name; the given order of the sheets counts.
    sheets = read_sheets(spark, {"N2O_AR5": write("z.csv", SHEET), "CH4_AR5": write("a.csv", renamed)})
    regions = rows(star.dim_geography(tidy.emissions(sheets)), "nuts_id")
    assert [r["nuts_label"] for r in regions if r["nuts_id"] == "AT11"] == ["Burgenland"]


def test_store_and_read_back(spark, tmp_path):
    path = str(tmp_path / "deep" / "table")
    df = spark.createDataFrame([("AT11", 2000), ("AT", 2001)], "geo string, year int")
    write_table(df, path, stamp=True, partition_by=("year",))
    back = read_table(spark, path)
    assert set(back.columns) == {"geo", "year", "created_date", "updated_date"} and back.count() == 2
    write_table(df.limit(1), path)
    assert read_table(spark, path).count() == 1


def test_load_or_build(spark, tmp_path):
    path, calls = str(tmp_path / "p"), []

    def build():
        calls.append(1)
        return spark.createDataFrame([("AT11", len(calls)), ("AT", len(calls))], "geo string, v int")

    assert load_or_build(spark, path, build, level_only=2).collect()[0]["v"] == 1
    assert load_or_build(spark, path, build).count() == 2 and len(calls) == 1
    assert load_or_build(spark, path, build, force_refresh=True).first()["v"] == 2


def test_load_population(spark, write, tmp_path):
    raw, stored = write("p.tsv", POPULATION_TSV), str(tmp_path / "stored")
    assert tidy.load_population(spark, stored, raw).count() == 2
    assert tidy.load_population(spark, stored, "/nowhere", level_only=0).count() == 0


def test_candidate_choice(spark):
    def source(codes, years):
        return spark.createDataFrame([(c, y, 1.0) for c in codes for y in years], "geo string, year int, population double")

    short = source(["AT11"], [2005, 2020])
    coarse = source(["AT"], [1999, 2020])
    good = source(["AT11"], [2000, 2013])
    assert choose_by_coverage({"a": short, "b": coarse, "c": good, "d": good}, "a") == "c"
    assert choose_by_coverage({"a": short, "b": coarse}, "b") == "b"


def test_geojson(spark, write):
    feature = lambda level, code: {
        "type": "Feature",
        "id": code,
        "properties": {"LEVL_CODE": level, "NUTS_ID": code, "URBN_TYPE": 3},
        "geometry": {"type": "Point", "coordinates": [1.5, 2]},
    }
    features = [feature(2, "AT11"), feature(0, "AT")]
    whole = write("a.geojson", json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    lines = write("a.geojsonl", "\n".join(json.dumps(f) for f in features))
    for df in (read_features(spark, whole), read_features(spark, lines, lines=True)):
        assert [r["id"] for r in rows(df, "id")] == ["AT", "AT11"]
        assert {r["properties"]["URBN_TYPE"] for r in rows(df)} == {"3"}
        kept = rows(dashboard.region_features(df))
        assert [(r["nuts_id"], json.loads(r["geometry"]["coordinates"])) for r in kept] == [("AT11", [1.5, 2])]


def test_profile_of_raw_tables(spark, write):
    df = read_wide_tsv(spark, write("a.tsv", CAUSES_TSV))
    stats = {r["stat"]: r["value"] for r in rows(profile.source_summary(df, "s", {"codes": "geo", "causes": "icd10"}))}
    assert stats == {
        "rows": 4,
        "first_year": 2010,
        "last_year": 2012,
        "n_years": 3,
        "codes": 3,
        "causes": 2,
        "level2_codes": 1,  # the untidy code "at12 " has five characters
    }
    done = rows(profile.completeness(df, last=2), "year")
    assert [(r["year"], r["valid"], r["total"], r["valid_pct"]) for r in done] == [(2011, 3, 4, 75.0), (2012, 4, 4, 100.0)]
    sheet = read_sheet(spark, write("s.csv", SHEET))
    missing = {r["stat"]: r["value"] for r in rows(profile.missing_cells(sheet, "s", r"Y_(\d{4})"))}
    assert missing == {"missing_values": 1, "missing_pct": 12.5}


def test_profile_of_codes(spark):
    df = spark.createDataFrame([(c,) for c in ["AT", "AT", "AT11", "AT12", "AT13", "DE1"]], "nuts_id string")
    assert [tuple(r.values()) for r in rows(profile.code_levels(df))] == [(2, 2, 1), (3, 1, 1), (4, 3, 3)]
    assert [r["code"] for r in rows(profile.code_sample(df, n=2))] == ["AT", "DE1", "AT11", "AT12"]
    names = {r["level_name"]: (r["n_rows"], r["n_codes"]) for r in rows(profile.named_levels(df, "nuts_id"))}
    assert names == {"Country": (2, 1), "NUTS1": (1, 1), "NUTS2": (3, 3)}


def test_respiratory_codes(spark):
    df = spark.createDataFrame([("J",), ("J45",), ("UPRESPIR_OTH",), ("C",), (None,)], "icd10_group string")
    assert {r["code"] for r in rows(profile.respiratory_codes(df))} == {"J", "J45", "UPRESPIR_OTH"}


def test_overlaps(spark):
    def years(*ys):
        return spark.createDataFrame([(y,) for y in ys for _ in range(2)], "year int")

    got = {r["measure"]: (r["first_year"], r["last_year"], r["n_years"]) for r in rows(
        profile.harmonization_window({"a": years(1990, 2011, 2012), "b": years(2011, 2012, 2020), "c": years(2012)})
    )}
    assert got["intersection"] == (2012, 2012, 1) and got["union"] == (1990, 2020, 4)
    assert got["a & b"] == (2011, 2012, 2) and got["a"] == (1990, 2012, 3)
    none = {r["measure"]: r["n_years"] for r in rows(profile.harmonization_window({"a": years(1), "b": years(2)}))}
    assert none["intersection"] == 0
    codes = {"x": spark.createDataFrame([("AT11",), ("AT",)], "nuts_id string"), "y": spark.createDataFrame([("AT11",), ("AT12",)], "nuts_id string")}
    shared = {r["measure"]: r["n_codes"] for r in rows(profile.region_overlap(codes))}
    assert shared == {"x": 1, "y": 2, "x & y": 1, "union": 2, "intersection": 1}


def test_spread_and_unpivot_round_trip(spark):
    from arealens.bindings import raw_discharges

    data = [("AT11", y, "A", "INPAT", "NR", "T", "TOTAL", "J", float(y - 1990)) for y in range(1995, 2002)]
    columns = "nuts_id string, year int, frequency string, indicator string, unit_code string, sex string, age_group string, icd10_group string, discharges double"
    numbered = [(*row, i) for i, row in enumerate(data + data)]  # rows that share all but their number
    df = spark.createDataFrame(numbered, f"{columns}, {SOURCE_ORDER} long")
    back = tidy.hospital_discharges(raw_discharges(df))
    assert sorted(map(tuple, back.collect())) == sorted((*r[:4], f"NR_{r[9]}", *r[5:9]) for r in numbered)
    assert back.filter(F.col("year").isNull()).count() == 0


def test_pipeline_from_files(spark, write, tmp_path):
    from arealens.plans import pipeline

    tidy_root, star_root = str(tmp_path / "tidy"), str(tmp_path / "star")
    pipeline.ingest(
        spark,
        tidy_root,
        {"Fossil CO2 AR5": write("e.csv", SHEET.replace("Y_1990,Y_1991", "Y_2010,Y_2011"))},
        write("c.tsv", CAUSES_TSV),
        write("d.tsv", DISCHARGES_TSV),
        write("p.tsv", POPULATION_TSV),
    )
    table = rows(pipeline.build_curated(spark, tidy_root, str(tmp_path / "curated")))
    assert [(r["nuts_id"], r["year"], r["total_emissions_kt"], r["cod_all_resp_rate"], r["discharge_all_resp"]) for r in table] == [
        ("AT11", 2010, 10.5, 61.2, 3200.0)
    ]
    assert table[0]["emissions_per_capita_tonnes"] == 10.5 * 1000 / 283697
    assert pipeline.build_curated(spark, tidy_root, str(tmp_path / "w"), years=(2011, 2021)).count() == 0
    loaded = pipeline.build_star(spark, tidy_root, star_root)
    facts = rows(loaded.vw_health_metrics, "nuts_id", "year", "icd10_code")
    assert [(r["nuts_id"], r["year"], r["icd10_code"], r["age_standardised_rate_per_100k"]) for r in facts] == [
        ("AT", 2010, "J", 55.1),
        ("AT", 2011, "J", 54.0),
        ("AT", 2012, "J", 53.2),
        ("AT11", 2010, "J", 61.2),
        ("AT11", 2011, "J", 51.5),
        ("AT11", 2012, "J", 52.0),
        ("AT12", 2010, "J45_J46", 1.4),
        ("AT12", 2011, "J45_J46", 1.3),
    ]


def test_long_order_is_year_by_year(spark, write):
    # The first row has no value in the first year, so the second row's label comes first.
    sheet = f"x\n{HEADER}\nCO2,AT,Austria,AT11,Late,Energy,,5\nCO2,AT,Austria,AT11,Early,Waste,1,\n"
    regions = rows(star.dim_geography(tidy.emissions({"CH4_AR5": read_sheet(spark, write("s.csv", sheet))})))
    assert [r["nuts_label"] for r in regions] == ["Early"]


def test_population_falls_back_to_candidates(spark, tmp_path):
    layout = "freq string, unit string, sex string, age string, geo string, TIME_PERIOD string, OBS_VALUE string"

    def candidate(*years):
        return spark.createDataFrame([("A", "NR", "T", "TOTAL", "AT11", str(y), str(y)) for y in years], layout)

    found = tidy.load_population(
        spark, str(tmp_path / "p"), None, {"short": candidate(2014, 2020), "long": candidate(2000, 2013)}, "short"
    )
    assert {r["year"] for r in rows(found)} == {2000, 2013}
    with pytest.raises(ValueError):
        tidy.load_population(spark, str(tmp_path / "q"), None)


def test_sheet_summary(spark, write):
    stats = {r["stat"]: r["value"] for r in rows(profile.sheet_summary(read_sheet(spark, write("s.csv", SHEET)), "s"))}
    assert stats == {
        "rows": 4,
        "regions": 3,
        "countries": 2,  # "aut" is counted as it stands
        "sectors": 3,
        "first_year": 1990,
        "last_year": 1991,
        "n_years": 2,
    }


def test_files_with_other_years_under_one_path(spark, tmp_path):
    head = "freq,unit,sex,age,icd10,geo\\TIME_PERIOD"
    (tmp_path / "a.tsv").write_text(f"{head}\t2010 \t2011 \nA,RT,T,TOTAL,J,AT11\t1 \t2 \n")
    (tmp_path / "b.tsv").write_text(f"{head}\t2011 \t2012 \t2013 \nA,RT,T,TOTAL,J,AT12\t11 \t12 \t13 \nA,RT,T,TOTAL,J,AT11\t9 \t9 \t9 \n")
    df = read_wide_tsv(spark, str(tmp_path))
    long = rows(tidy.causes_of_death(df), SOURCE_ORDER)
    value = "age_standardised_rate_per_100k"
    assert {(r["nuts_id"], r["year"], r[value]) for r in long if r["nuts_id"] == "AT12"} == {
        ("AT12", 2011, 11.0), ("AT12", 2012, 12.0), ("AT12", 2013, 13.0)
    }
    # The first file's row comes first, by one number that hash aggregation can order by.
    first = star._health_rows(tidy.causes_of_death(df), "first", value)
    assert {(r["nuts_id"], r["year"]): r[value] for r in rows(first)}["AT11", 2011] == 2.0
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    (tmp_path / "c.tsv").write_text("freq,sex,geo\\TIME_PERIOD\t2010\nA,T,AT11\t1\n")
    with pytest.raises(ValueError):
        read_wide_tsv(spark, str(tmp_path))


def test_wide_sheet_keeps_all_columns(spark, write):
    names = HEADER.split(",")[:6] + [f"Y_{1850 + i}" for i in range(140)]
    line = ["CH4", "AT", "Austria", "AT11", "Burgenland", "Energy"] + [str(i) for i in range(140)]
    sheet = read_sheet(spark, write("w.csv", "\n".join(["preamble,x", "", ",".join(names), ",".join(line)]) + "\n"))
    assert sheet.columns == names + [SOURCE_ORDER] and sheet.count() == 1
    assert sheet.first()["Y_1989"] == "139"


def test_rows_without_a_code_are_dropped(spark, write):
    sheet = read_sheet(spark, write("n.csv", HEADER + "\n" + ",".join(["CH4", "AT", "Austria", "", "x", "Buildings"] + ["1"] * (len(HEADER.split(",")) - 6)) + "\n"))
    assert tidy.emissions({"CH4_AR5": sheet}).count() == 0


def test_broken_population_file_gives_way_to_candidates(spark, write, tmp_path):
    long = spark.createDataFrame([("A", "NR", "T", "TOTAL", "AT11", "2001", "5")], "freq string, unit string, sex string, age string, geo string, TIME_PERIOD string, OBS_VALUE string")
    for i, path in enumerate((str(tmp_path / "absent.tsv"), write("bad.tsv", "a\tb\n1\t2\n"))):
        got = tidy.load_population(spark, str(tmp_path / f"p{i}"), path, {"long": long})
        assert [tuple(r) for r in got.collect()] == [("AT11", 2001, 5.0)]


def test_candidate_years_come_from_the_headers(spark, tmp_path):
    head = "freq string, sex string, unit string, age string, `geo\\TIME_PERIOD` string"
    cells = ", ".join(f"`{y}_value` double, `{y}_flag` string" for y in (1999, 2000, 2014))
    # Its early columns are empty, but they are there.
    sparse = spark.createDataFrame([("A", "T", "NR", "TOTAL", "AT11", None, None, None, None, 5.0, "p")], f"{head}, {cells}")
    other = spark.createDataFrame([("A", "NR", "T", "TOTAL", "AT12", "2013", "7")], "freq string, unit string, sex string, age string, geo string, TIME_PERIOD string, OBS_VALUE string")
    got = tidy.load_population(spark, str(tmp_path / "p"), None, {"other": other, "sparse": sparse}, default="other")
    assert [tuple(r) for r in got.collect()] == [("AT11", 2014, 5.0)]


def test_failed_refresh_keeps_the_stored_table(spark, tmp_path):
    path = str(tmp_path / "kept")
    good = spark.createDataFrame([("AT11", 1), ("AT", 1)], "geo string, v int")
    assert load_or_build(spark, path, lambda: good).count() == 2

    def broken():
        return good.select("geo", F.raise_error(F.lit("source lost")).alias("v"))

    with pytest.raises(Exception):
        load_or_build(spark, path, broken, force_refresh=True).count()
    assert sorted(tuple(r) for r in load_or_build(spark, path, lambda: good.limit(0)).collect()) == [("AT", 1), ("AT11", 1)]


def test_sheet_header_after_many_look_alike_lines(spark, write):
    look_alike = "".join(f"Substances of group {k},x\nSubstance X{k},y\n\"Substance {k}\",z\n" for k in range(150))
    quoted = SHEET.replace(HEADER, '"Substance"' + HEADER[len("Substance"):])
    df = read_sheet(spark, write("many.csv", look_alike + quoted))
    assert df.columns == HEADER.split(",") + [SOURCE_ORDER]
    assert df.count() == 4

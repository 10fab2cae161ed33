"""Every catalog query against its SQL, row by row."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
from arealens import catalog
from sql_oracles import ORACLES
from tests.compare import connect, differences
from tests.conftest import DATA


@pytest.fixture(scope="module")
def duck():
    if not Path(DATA).exists():
        pytest.skip("no test data")
    return connect(DATA)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(ORACLES)


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    assert differences(driver.queries()[name](spark, DATA), ORACLES[name], duck) == []


def test_invariants(spark):
    if not Path(DATA).exists():
        pytest.skip("no test data")
    run = {n: driver.queries()[n](spark, DATA).toPandas() for n in ("emissions_wide", "curated_all_levels", "ingest_population", "verify_grain", "verify_orphans", "verify_required")}
    wide = run["emissions_wide"]
    groups = [c for c in wide.columns if c.startswith("emissions_")]
    assert (wide["total_emissions_kt"] - wide[groups].sum(axis=1)).abs().max() < 1e-6
    keys = lambda df, code: set(zip(df[code], df["year"]))
    both = keys(wide, "nuts_id") & keys(run["ingest_population"], "geo")
    assert keys(run["curated_all_levels"], "nuts_id") == both
    assert len(run["curated_all_levels"]) == len(both)
    assert run["verify_grain"]["n_surplus"].sum() == 0
    assert run["verify_orphans"]["n_orphans"].sum() == 0
    assert run["verify_required"]["n_missing"].sum() == 0


def test_entry(spark):
    if not Path(DATA).exists():
        pytest.skip("no test data")
    assert driver.entry(spark).count() > 0

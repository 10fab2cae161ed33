"""op12: fill-in-the-middle against a plain Python version of the contract."""

from __future__ import annotations

import hashlib

import pytest

from arealens.llm import fim
from tests.compare import connect


def expected(doc_id, text):
    body = text or ""
    n = len(body)
    if doc_id is None:
        return (doc_id, n, "plain", None, None, body, body)
    dg = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(dg[8 * k : 8 * k + 8], 16) for k in range(4)]
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = body[:lo], body[lo:hi], body[hi:]
    if n == 0 or any(s in body for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, body, body)
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", lo, hi - lo, "<S>" + suf + "<P>" + pre + "<M>" + mid, body)
    return (doc_id, n, "psm", lo, hi - lo, "<P>" + pre + "<S>" + suf + "<M>" + mid, body)


AWKWARD = [
    (1, None),
    (2, ""),
    (3, "   "),
    (4, "héllo wörld ✓ 漢字 😀 end"),
    (5, "has <P> inside"),
    (6, "x" * 200_000),
    (7, "😀" * 5000),
    (None, "no id"),
    (8, "repeated row"),
    (8, "repeated row"),
] + [(k, f"text number {k} with ünïcode ☃ and more words {k * k}") for k in range(10, 400)]


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = fim.fill_in_middle(df, **kw).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fim.restore(df_col("output"), df_col("form")).alias("r")
    )
    return sorted((tuple(r) for r in got.collect()), key=repr)


def df_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


@pytest.mark.parametrize("slice_bytes", [4 << 20, 100])
def test_equals_contract(spark, slice_bytes):
    assert run(spark, AWKWARD, slice_bytes=slice_bytes) == sorted((expected(*r) for r in AWKWARD), key=repr)


def test_all_forms_occur():
    forms = {expected(*r)[2] for r in AWKWARD}
    assert forms == {"plain", "psm", "spm"}


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "abc", "x", 5)], "doc_id long, text string, output string, _low int")
    got = fim.fill_in_middle(df).collect()
    assert [(r.doc_id, r.output) for r in got] == [(1, expected(1, "abc")[5])]


def test_query_equals_sql(spark):
    from tests.conftest import DATA

    got = sorted((tuple(r) for r in fim.fim_query(spark.read.parquet(f"{DATA}/documents.parquet")).collect()), key=repr)
    con = connect(DATA)
    want = sorted((tuple(r) for r in con.execute(fim.ORACLE).fetchall()), key=repr)
    assert got == want

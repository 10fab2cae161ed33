"""The pipeline stage by stage against brute force."""

from __future__ import annotations

import re

import corpus_pipeline
from arealens.llm import pii
from tests.conftest import DATA
from tests.llm.cases import documents, empty
from tests.llm.test_operators import base_pii, components


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.toPandas().set_index("doc_id")
        assert not seen[name].index.has_duplicates
        if name != "sentencepiece":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    start = spark.read.parquet(f"{DATA}/documents.parquet").toPandas().set_index("doc_id")
    lettered = {i for i, t in start.text.items() if re.search(r"[^\W\d_]", t or "")}
    assert set(seen["language_id"].index) == lettered
    groups = components((i, t) for i, t in start.text.items() if i in lettered)
    assert set(seen["near_dedup"].index) == {i for i, (_, least) in groups.items() if i == least}
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = {i for i, t in seen["near_dedup"].text.items() if not any(item in plain(t) for item in items)}
    assert set(seen["decontamination"].index) == clean
    masked = seen["personal_data"]
    assert set(masked.index) == clean
    for i, text in masked.text.items():
        found = base_pii(start.text[i])
        assert not base_pii(text) and (text == start.text[i]) <= (not found) and masked.n_chars[i] == len(text)
        assert all(f"[{kind.upper()}]" in text for kind, _, _ in found) or len({k for k, _, _ in found}) > 1
    assert seen["sentencepiece"].round_trip.all() and (seen["sentencepiece"].n_tokens > 0).all()


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_awkward_tables(spark, tmp_path):
    for name, table in (("awkward", documents(spark)), ("empty", empty(spark))):
        docs = table
        for stage, step in corpus_pipeline.STAGES:
            step(spark, docs, DATA).write.parquet(f"{tmp_path}/{name}-{stage}")
            docs = spark.read.parquet(f"{tmp_path}/{name}-{stage}")
        assert (docs.count() > 0) == (name == "awkward")
    assert pii.KINDS

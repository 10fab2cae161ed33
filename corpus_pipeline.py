"""From raw documents to tokens: five stages, each over all that the stage before kept.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame, which is written and
read again as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.llm import catalog, decontaminate, language, near_dup, pieces, pii
from arealens.llm.scratch import Scratch, small_batches

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*[docs[c] for c in COLUMNS])


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a recognised language; those without any letter go. Columns stay as they are."""
    small_batches(spark)
    docs = _columns(docs)
    model = language.fit(docs.filter(~language.held_out()))
    return language.identify(docs, model).filter(F.col("lang_pred") != language.UNDETERMINED).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    small_batches(spark)
    return near_dup.one_of_each(_columns(docs))


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a test item of the benchmark."""
    small_batches(spark)
    return decontaminate.decontaminated(_columns(docs), spark.read.parquet(f"{folder}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data in texts replaced by its kind; n_chars follows the text."""
    small_batches(spark)
    docs = _columns(docs)
    found = pii.masked(docs, pii.fit(docs))
    return found.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, n_tokens, token_ids and round_trip of every document."""
    small_batches(spark)
    return pieces.pieces_query(_columns(docs), pieces.load_vocabulary(catalog.VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents`` of the folder, one after the other."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.keep(docs, name)
    return docs


# Language models, message passing and merges of pieces are not SQL; tests compare with brute force.
ORACLE_SQL = None

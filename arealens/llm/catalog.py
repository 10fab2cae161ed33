"""The operators as queries over the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import ORACLE as CHAT_SQL
from .chat import chat_query
from .decontaminate import leaks
from .embed_dup import embedding_query
from .extract import extraction_query
from .fim import ORACLE as FIM_SQL
from .fim import fim_query
from .language import language_query
from .licenses import license_query
from .near_dup import near_duplicates
from .pii import pii_query
from .pieces import load_vocabulary, pieces_query
from .quality import ORACLE as QUALITY_SQL
from .quality import quality_query
from .repair import repair_query
from .scratch import small_batches
from .secret_scan import secrets_query


def _over(*tables: str):
    """A query from a function of tables: each is read whole from the folder."""

    def bind(build: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def query(spark: SparkSession, folder: str) -> DataFrame:
            small_batches(spark)
            return build(*[spark.read.parquet(f"{folder}/{t}.parquet") for t in tables])

        return query

    return bind


# The vocabulary that the tokenizing query uses; any SentencePiece model with byte pieces would do.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": _over("documents")(license_query),
        "op2_chat_format": _over("conversations")(chat_query),
        "op3_sentencepiece": _over("documents")(lambda docs: pieces_query(docs, load_vocabulary(VOCABULARY))),
        "op4_main_text": _over("pages")(extraction_query),
        "op5_language_id": _over("documents")(language_query),
        "op6_pii": _over("documents")(pii_query),
        "op7_quality_rules": _over("documents")(quality_query),
        "op8_decontamination": _over("documents", "benchmark")(leaks),
        "op9_secrets": _over("documents")(secrets_query),
        "op10_near_dup": _over("documents")(near_duplicates),
        "op11_embed_dup": _over("embeddings")(embedding_query),
        "op12_fim": _over("documents")(fim_query),
        "op13_conv_repair": _over("conversations")(repair_query),
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_format": CHAT_SQL, "op7_quality_rules": QUALITY_SQL, "op12_fim": FIM_SQL}

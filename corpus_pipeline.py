"""A corpus pipeline of five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of `documents`,
further ones too, whatever their names; an empty table gives an empty one in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from periodica.llm.bpe import digests, tokenize, vocabulary
from periodica.llm.common import stored
from periodica.llm.exact_dedup import drop_copies
from periodica.llm.language_id import keep_identified
from periodica.llm.mixing import mix
from periodica.llm.near_dedup import drop_near_copies


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found go: those that are null, empty or have no letter. Other
    documents stay, repeated rows and rows without an id too."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal after lower-casing A-Z the one with the largest doc_id stays,
    once if its row is repeated. A null text counts as empty. Rows with a null doc_id stay."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest doc_id stays
    (rows that repeat its doc_id with it). Texts without words link with nothing. Rows with a null doc_id stay."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are replicated (or left out) so that sources meet their target shares, and shuffled.
    A null source is a source; rows that share a doc_id draw by their texts, equal rows draw the same."""
    return mix(docs).select("row.*")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text is encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256. A null
    or empty text has no tokens; each row has its result."""
    return digests(tokenize(docs, vocabulary()))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("bpe", bpe),
]

ORACLE_SQL = None  # MinHash and the tokenizer have no SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

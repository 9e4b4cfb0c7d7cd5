"""Cleaning of a corpus in five stages, each written as Parquet and read again by the next.

A stage is a function of (spark, docs, sf_dir). All but the last return the columns of `documents`; the
last returns the token ids of every text that is left, with the digests of ids and decoded bytes.

Stages carry all columns along, whatever their names. A null doc_id stays null; where an order of documents
matters it is the smallest. Rows that repeat a doc_id are judged row by row, except where a stage says otherwise.
An empty table passes through all stages. SQL cannot express language identification, MinHash or byte-level BPE, so
there is no ORACLE_SQL; the stages are tested against brute force in tests/llm.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.llm import byte_bpe, decontamination, language, line_dedup, near_dedup
from saleslens.llm.shared import ready, stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. Null and empty texts and texts without a letter go."""
    ready(spark)
    return language.keep_identified(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds. A document of which nothing but blanks is left
    goes, as do texts that were empty before; a null text stays. Rows that share a doc_id lose the same lines."""
    ready(spark)
    left = line_dedup.without_repeats(docs)
    return left.where(F.col("text").isNull() | (F.length(F.trim(F.translate("text", "\t\n\x0b\x0c\r", " "))) > 0))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group of near duplicates; equal texts without words are a group too. Null and
    empty texts stay. Of rows that share a doc_id, all stay or none."""
    ready(spark)
    return near_dedup.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window. Texts without words, null ones among them, hold none and stay."""
    ready(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids of the whole text (`ids`: little-endian unsigned 32-bit numbers), their count and digest, and the
    digest of the bytes decoded from them, row by row. A null or empty text has no ids."""
    ready(spark)
    decoded = byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.digests(decoded, "ids")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

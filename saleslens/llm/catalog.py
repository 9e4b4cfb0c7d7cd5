"""Registered queries of this package and their SQL counterparts."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from saleslens.llm import (
    byte_bpe,
    collocations,
    decontamination,
    language,
    lexical_search,
    line_dedup,
    near_dedup,
    pii_spans,
    sharding,
    substring_dedup,
    token_files,
    top_k,
    toxicity,
)
from saleslens.llm.shared import ready, table

Query = Callable[[SparkSession, str], DataFrame]


def _on_documents(operator: Callable[..., DataFrame], *arguments) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ready(spark)
        return operator(table(spark, sf_dir, "documents"), *arguments)

    return query


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return token_files.query(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return decontamination.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return top_k.query(table(spark, sf_dir, "embeddings"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return lexical_search.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        "op1_token_files": _op1,
        "op2_line_dedup": _on_documents(line_dedup.query),
        "op3_substring_dedup": _on_documents(substring_dedup.query),
        "op4_byte_bpe": _on_documents(byte_bpe.query, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
        "op5_sharding": _on_documents(sharding.query),
        "op6_toxicity": _op6,
        "op7_decontamination": _op7,
        "op8_language": _on_documents(language.query),
        "op9_near_dedup": _on_documents(near_dedup.query),
        "op10_top_k": _op10,
        "op11_lexical_search": _op11,
        "op12_pii_spans": _on_documents(pii_spans.query),
        "op13_collocations": _on_documents(collocations.query),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": line_dedup.ORACLE_SQL,
        "op10_top_k": top_k.ORACLE_SQL,
        "op11_lexical_search": lexical_search.ORACLE_SQL,
        "op13_collocations": collocations.ORACLE_SQL,
    }

"""A corpus pipeline of five of the library's operators, each stage written and read again.

Stages drop what they reject: texts of no known language, all but one document of each group of near
duplicates, documents that hold benchmark items, and what exceeds the budgets of the mix. The last one
writes the token ids of what is left, and returns a digest of them as read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, jaccard, language, mixing, packed
from tidemark.llm.common import free_name, table, written
from tidemark.llm.queries import BYTE_BPE_IDS, END_ID, MIX_SEED, MIX_WEIGHTS, byte_bpe, with_domain

#: Part of the tokens that the mix keeps, in percent; no document is taken twice.
MIX_PERCENT = 80
#: Two stages learn or encode in Python, which SQL cannot express; the tests hold a brute-force version.
ORACLE_SQL: str | None = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grouped, domain = with_domain(docs)
    chosen = mixing.mix(grouped, [domain, "lang", "source"], MIX_WEIGHTS, percent=MIX_PERCENT, max_epochs=1,
                        seed=MIX_SEED, copies=free_name(grouped, "copies"))
    return chosen.select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed.read_documents(packed.write_blocks(docs, byte_bpe(), END_ID, BYTE_BPE_IDS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

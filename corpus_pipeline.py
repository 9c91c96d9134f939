"""From raw documents to packed sequences, one operator per stage, each written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from capplan.llm import decontaminate, line_dedup, ngram_join, packing, quality
from capplan.llm.common import shared_folder, table
from capplan.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the boilerplate lines of their hosts."""
    return quality.clean_documents(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one."""
    return line_dedup.drop_repeated_lines(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near copies link."""
    return ngram_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth comes from the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 2048 tokens."""
    return packing.pack(packing.token_pieces(docs, tokenizer_file(), ids=False))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Packing is an evolutionary search; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus made ready for training, stage by stage, each over all that the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barloom.llm import byte_bpe, decontaminate, line_dedup, quality_rules, simhash
from barloom.llm.common import written


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that their source repeats on over a tenth of its documents."""
    return line_dedup.drop_boilerplate(docs, "source", ratio=0.1, least_pages=5, length="n_chars")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: three-word shingles, three bits."""
    return simhash.keep_one_of_each(docs, width=3, budget=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests that show the round trip."""
    bpe = byte_bpe.ByteBPE(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.token_digests(bpe, docs, keep_ids=True)


STAGES = [
    ("quality rules", good_text),
    ("line dedup", without_boilerplate),
    ("simhash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("byte-level bpe", encoded),
]

#: SQL can express neither zstandard nor the tokenizer; the tests hold run() against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared work folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{k}")
    return docs

"""Training-text pipeline: the stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadsmith.llm.common import bound_batches
from loadsmith.llm.debruijn import cut_repeats
from loadsmith.llm.decontam import remove_contaminated
from loadsmith.llm.langid_hd import keep_known_languages
from loadsmith.llm.lsh_forest import drop_near_duplicates
from loadsmith.llm.packing import pack
from loadsmith.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go (language 'und'); the score of a language is no reason to drop a text."""
    bound_batches(spark)
    return keep_known_languages(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (shingles of five words, similarity 0.8)."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur again are cut out; documents left without a word go."""
    return cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly such passages go."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, dealt to sequences of 1024."""
    import public_tokenizers

    return pack(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Learned profiles and a tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

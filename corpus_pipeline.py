"""Corpus pipeline: language ID, near-duplicates, personal data, source mix and
packing, each stage written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from campaignlake.llm import langid, mixing, packing, pii, setjoin
from campaignlake.llm.common import remainder, small_batches, table, written
from campaignlake.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words' languages are not known go; those that switch languages stay."""
    small_batches(spark)
    return langid.accepted(docs, remainder("doc_id", 4) != 2)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 0.8)."""
    small_batches(spark)
    return setjoin.one_of_each(docs, n=5, num=80, den=100)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts; every document stays."""
    small_batches(spark)
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in schedule order."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their token ids."""
    small_batches(spark)
    return packing.pack(packing.tokenize(docs, tokenizer_path()))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("source_mix", source_mix), ("pack", pack)]

# Trained models and a tokenizer are beyond SQL; tests/llm holds the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

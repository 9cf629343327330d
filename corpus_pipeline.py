"""The corpus pipeline: five stages over ``documents``, each reading what its predecessor kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; between stages
the result is written as Parquet below the shared folder and read again.  All
stages but the last return the columns of ``documents``.  A stage applies the
runtime settings itself, as it may be called alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from engagelake.llm import decontaminate, near_dedup, packing, pii, quality_rules
from engagelake.llm.common import written
from engagelake.llm.queries import table, tokenizer_path
from engagelake.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    configure(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    configure(spark)
    return near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    configure(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in their texts."""
    configure(spark)
    return pii.redact(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in packed sequences."""
    configure(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality_rules", quality), ("near_dedup", near_duplicates), ("decontamination", decontamination),
          ("pii", private_data), ("packing", best_fit)]

#: Tokenisation has no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: quality rules, near-duplicates, personal data, source mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; what it returns is written as
Parquet into the shared folder and read again as the next stage's documents. The first four return the columns of
``documents``; the last returns the packed sequences. Nulls, ties and empty tables are handled as the operators of
``textsift.llm`` say; extra columns of the documents pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textsift.llm import mixing, packing, pii, quality, simhash
from textsift.llm.common import saved
from textsift.session import ship, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    ship(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component."""
    ship(spark)
    return simhash.keep_one(docs, shingle=4, radius=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts."""
    ship(spark)
    return pii.mask_pii(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the target weights of domain, language and source take from one epoch."""
    ship(spark)
    return mixing.select_documents(docs, mixing.document_levels(), mixing.WEIGHTS, budget=(9, 10), seed=7)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the texts into sequences and places them in batches of optimal length buckets."""
    ship(spark)
    return packing.pack(docs, max_tokens=2048, buckets=8, batch_tokens=65536, seed=11)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixture", source_mixture),
    ("packing", packed_sequences),
]

#: Fingerprints and estimated rule accuracies have no SQL form; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

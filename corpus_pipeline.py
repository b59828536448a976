"""The corpus pipeline: language ID, exact dedup, near dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of ``documents``; the last returns pieces with their sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitchline.llm import decontaminate, exact_dedup, language_id, packing, simhash
from pitchline.llm.common import bounded_batches, read_table, stored


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from the labelled ones; texts without letters or in no such language go."""
    bounded_batches(spark)
    filters = language_id.train(docs.where(~language_id.held_out()).select("lang", "text"))
    return language_id.keep_known(docs, filters)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    bounded_batches(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints."""
    bounded_batches(spark)
    return simhash.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark passages."""
    bounded_batches(spark)
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and the sequences that hold them."""
    bounded_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Token ids, hashes and fingerprints have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

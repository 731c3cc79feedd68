"""From raw documents to packed token sequences: the stages of the corpus pipeline, in order.

Every stage reads the table that the one before it wrote. A document whose quality is rejected
goes; common blocks go from later documents, and with them those that had nothing else; one
document of each SimHash component stays, the one with the smallest id; documents that hold a
benchmark item go; the rest is packed into sequences of 2,048 token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.llm import decontamination, line_dedup, packing, quality, simhash
from paneltide.llm.common import table, written
from paneltide.llm.queries import vocabulary


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = line_dedup.rest(docs, anywhere=True)
    return rest.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=3, distance=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality_classifier", accept),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("benchmark_decontamination", decontaminate),
    ("packing", pack),
]

# A trained classifier, XXH64 fingerprints and a tokenizer have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

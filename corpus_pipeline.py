"""The corpus pipeline: documents through quality rules, near-duplicate removal, benchmark
decontamination, personal data and encoding.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read again
as the next one's ``docs``.  All stages but the last return the columns of the documents.  Null, empty,
very long and repeated rows are handled as the stages' operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cataloom.llm import bpe, decontaminate, pii, quality, simhash
from cataloom.llm.common import table, written
from cataloom.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without personal data and what discloses it; ``n_chars`` follows."""
    out = pii.sanitised(docs)
    if "n_chars" not in docs.columns:
        return out
    from pyspark.sql import functions as F

    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    return bpe.round_trip(docs, *vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("pii", personal_data),
    ("byte_bpe", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; a stage's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: quality rules, near duplicates, personal data, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the
last return the columns of ``documents``. The packing stage returns the packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cuesheet.llm import mixing, packing, pii, quality_rules, similar_texts
from cuesheet.llm.common import durable
from cuesheet.llm.queries import _vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar_texts.one_of_each(docs)


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, _vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("pii", privacy_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Pseudonyms, fingerprints and token ids are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Training-corpus pipeline over ``documents``.

STAGES lists (name, function): each function takes (spark, docs, sf_dir) and
returns the documents that stay, with the same columns; the last returns the
packed pieces.  Each stage's result is written as Parquet and read again as
the next one's documents.

1. quality rules: documents that fail the base rules or a certified rule go;
2. near duplicates (SimHash, 4-word shingles, 4 bits): one document of each
   group stays;
3. personal data: spans are replaced by their kind in brackets;
4. mixing: documents are repeated or left out towards the source weights;
5. packing: token sequences of at most 2048.

Defined results: null texts fail the base rules and go with stage 1; an empty
table stays empty through all stages; extra columns are kept up to stage 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rxlens.llm import mixing, packing, pii, quality_rules, simhash
from rxlens.llm.common import land, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_duplicates), ("pii", personal_data),
          ("mixing", mix), ("packing", pack)]

# calibrated thresholds, XXH64 fingerprints and tokenization are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus pipeline of five stages over ``documents``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's ``docs``; the tables used up are deleted.
All but the last keep the columns of ``documents``.

1. language ID: rows whose language is rejected go (no letter, or no clear
   language);
2. exact dedup: one row of equal texts stays;
3. MinHash near-dedup: one document of each group of similar texts stays;
4. secret scans: every secret in a text is replaced by a mark;
5. best-fit packing: one row per piece with its place in a packed sequence.

Nulls, empty and very long texts, repeated rows and empty tables are treated as
the operators say; extra columns are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rateflow.llm import exact_dedup, language, near_dedup, packing, secrets
from rateflow.llm.common import documents, release, tables_written, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

# Compression, signatures and tokenisation are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), tables_written(spark)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        # The stage before, and what this one's operator has written, are used up.
        release(spark, since=before, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)

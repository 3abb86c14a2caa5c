"""Corpus pipeline: five stages over ``documents``, each one of the corpus operators.

1. language ID: documents without a language (``und``) go;
2. n-gram Jaccard join: one document of each near-duplicate group stays;
3. benchmark decontamination: documents with a benchmark window go;
4. mixing: documents as often as the source weights ask, in shuffled shards;
5. token ids: the token store, read back.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shapekit.llm import decontaminate, lang_id, mixing, shingle_join, token_store
from shapekit.llm.queries import table, tokenizer_path
from shapekit.session import scratch_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_id.known_language(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shingle_join.without_near_copies(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(spark, docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_store.round_trip(spark, docs, tokenizer_path())


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mix),
    ("token_ids", token_ids),
]

#: trained models, sketches and tokenisation have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Raw documents to token ids: language, duplicates, mixture, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept;
its result is written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortkit.llm import language, mixing, queries, sentencepiece_codec, simhash
from cohortkit.llm.common import table
from cohortkit.session import scratch, shared_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without texts that have no letter or no clear language."""
    return language.filter_language(docs, language.learn_dictionaries(docs, queries.language_rule()))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for the case of A-Z) the row with the largest doc_id."""
    return queries.new_index(spark).deduplicate(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest doc_id."""
    return simhash.one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights, repeated where a source is short."""
    return mixing.mixed_documents(docs, queries.levels(), queries.WEIGHTS, **queries.MIXTURE)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of whole texts; small batches, since workers of earlier stages hold memory too."""
    model = sentencepiece_codec.read_model(queries.MODEL_PATH)
    return sentencepiece_codec.encode_documents(docs, model, known_words=200_000, batch_chars=500_000)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]
# Compression, fingerprints and token ids have no SQL form; tests/llm/test_pipeline.py has
# each stage in plain Python and compares run() with them row by row.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the table documents of ``sf_dir``.

    A stage's own intermediate tables go when its result is written.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/cohortkit-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""From raw documents to packed training sequences, in five stages.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read back as the docs of
the next.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import mixing, near_dedup, packing, pii, quality
from newsflow.llm.queries import tokenizer_file
from newsflow.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outlier of their language and source."""
    return quality.kept_documents(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (similarity 0.8 or more on 5-word shingles)."""
    return near_dedup.one_of_each(docs, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data redacted; n_chars follows the text."""
    clean = pii.without_personal_data(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by the mix, in training order."""
    return mixing.mixed_documents(docs)


def curve_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("minhash_near_dedup", minhash_near_dedup),
          ("personal_data", personal_data), ("source_mix", source_mix), ("curve_packing", curve_packing)]

#: Near-duplicate groups, robust estimates and tokens are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written in the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/newsflow-llm/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

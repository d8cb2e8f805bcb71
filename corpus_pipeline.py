"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it drops is gone for those after it. All but the
last return the columns of documents. ORACLE_SQL is None: SQL can't fit the toxicity model; tests/llm/test_pipeline.py
holds the stages against plain versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.common import discard, durable, scratch
from ledgerloom.llm.exact import drop_exact
from ledgerloom.llm.minmax import drop_near
from ledgerloom.llm.mixing import mixed
from ledgerloom.llm.packing import pack
from ledgerloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("source_mix", source_mix), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}", outlives=True)
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)

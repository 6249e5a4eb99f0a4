"""Corpus pipeline: quality filter, near-duplicates, secrets, source mix, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept;
its result is written as Parquet and read again as the next one's docs.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedworks.llm import bpe, mixing, quality, secrets, simhash
from feedworks.llm.common import stored

#: The mix has nine tenths of the tokens that are left.  Domains and languages get shares by these target
#: weights; sources that weigh much for their size are taken up to twice, those that weigh little in part.
MIX = {"share": (9, 10), "max_epochs": 2, "weights": mixing.WEIGHTS}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blotted out; every document stays."""
    return secrets.redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source gives the documents of its token budget."""
    return mixing.take_mix(docs, **MIX)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", quality_stage), ("simhash", simhash_stage), ("secrets", secrets_stage), ("mixing", mixing_stage),
          ("bpe", bpe_stage)]

#: A fitted classifier and the merges of a vocabulary are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

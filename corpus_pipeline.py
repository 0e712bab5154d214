"""A training corpus from ``documents``: toxicity, exact and near copies, mixing, packing.

Each stage is one operator of ``sigmesh.llm``; it gets all rows its
predecessor kept, and its result is written to the shared folder and read
again as the next stage's input. All stages but the last return the columns
of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from sigmesh.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from sigmesh.llm.common import Scratch
from sigmesh.llm.queries import _tokenizer, domains_of

#: Target weights of the mixture, met by dropping alone: the domain that lacks most stays whole.
WEIGHTS = {"good": 0.92, "junk": 0.08}


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(spark, docs, toxicity.fit(docs, _labels(spark, sf_dir)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(spark, docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.thin(spark, docs, domains_of(_labels(spark, sf_dir)), WEIGHTS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, docs, _tokenizer("word_bpe_49k.json"), 1)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_to_weights),
    ("packing", pack),
]

#: A trained classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs

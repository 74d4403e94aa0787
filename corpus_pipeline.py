"""The corpus pipeline: each stage calls one operator of ``paylens.llm``.

Stages get (spark, docs, sf_dir) and return the rows they keep with all
columns of ``docs``; the last returns the packed pieces. A stage's result
is written to the shared folder and read again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylens.llm import binslack, dartminhash, decontam, gracededup, toxgrammar
from paylens.llm.common import materialise, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxgrammar.drop_toxic(docs, toxgrammar.fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return gracededup.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dartminhash.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return binslack.pack(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: The first stage learns its model, which SQL cannot express; tests/llm compares a run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

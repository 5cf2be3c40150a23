"""A corpus pipeline of five stages over the documents table.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the last
adds each row's slot and shard. ``run`` writes every stage as Parquet to the shared folder
and reads it back, so a lost executor costs a stage's tasks at most.

1. quality rules: documents that fail, or whose host is condemned, go;
2. n-gram Jaccard join: one document of each group of linked documents stays;
3. benchmark decontamination: documents that hold a copied test item go;
4. mixing: every document is repeated or left out as its rate says (rates of one or more
   never lose a document);
5. sharding: every row gets its shard.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from indistar.llm import decontamination, jaccard_join, mixing, quality_rules, sharding
from indistar.llm.common import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.apply(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.Mixer(docs, _table(spark, sf_dir, "labels")).resample(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: Alignment scores and fitted rates are not SQL. No test compares a whole run with brute force; the operators have their own.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

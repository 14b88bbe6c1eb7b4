"""A training corpus from raw documents: quality rules, near-duplicate removal,
benchmark decontamination, mixing to target weights, sharding.

Each stage takes the rows that its predecessor kept, written as Parquet and
read again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlab.llm import decontaminate, jaccard, mixing, quality, shards
from churnlab.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content lines; the
    line model is fitted on the labelled ones among them."""
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by Jaccard similarity."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target weights of source, language and topic."""
    return mixing.sample(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard of 40."""
    return shards.label(docs, shards.tree(5, 2, 4))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mix), ("sharding", sharding)]

#: the line model and the alignment have no SQL form; tests/llm has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "_"))
    return docs

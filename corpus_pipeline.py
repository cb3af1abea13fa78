"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. `run` does that over documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm.common import materialise
from loomgraph.llm.decontaminate import drop_leaks
from loomgraph.llm.langid import keep_identified
from loomgraph.llm.mixing import mix_documents
from loomgraph.llm.near_dedup import drop_near_duplicates
from loomgraph.llm.sharding import shard_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    return drop_near_duplicates(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return shard_documents(docs, shards=8)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: Language ID by trained machines and MinHash near-dedup have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs)
    return docs

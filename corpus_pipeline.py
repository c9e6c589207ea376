"""A training corpus from raw documents in five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns what goes on: all columns of documents, and after the
last one also the shard of each row. A null text is an empty one to all stages; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkcurate.llm import decontamination, mixing, sharding, simhash, toxicity
from sparkcurate.llm.common import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the machine trained on `labels` rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rules = toxicity.ToxicityRules()
    known = labels.filter(~toxicity.held_out())
    model = toxicity.train(docs.select("doc_id", "text"), known, rules, Scratch(spark))
    scored = toxicity.score_documents(docs, docs.columns, model, rules)
    return scored.filter("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least id."""
    return simhash.keep_one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold an item of `benchmark`."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontamination.drop_leaks(docs, items)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to the target weights of the sources takes it."""
    return mixing.mix_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the shard of each."""
    return sharding.assign_shards(docs, shards=16)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("sharding", shard),
]

#: A trained classifier and a latent projection can't be written as SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = Scratch(spark).store(stage(spark, docs, sf_dir))
    return docs

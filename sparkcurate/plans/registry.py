"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """documents as grouped records: language is the family, source the species."""
    docs = table(spark, folder, "documents")
    prefix = F.when(F.col("doc_id") % 50 == 0, "NC_").otherwise("DOC")
    return docs.select(
        F.col("lang").alias("family"),
        F.col("source").alias("species"),
        F.concat(prefix, F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("accession"),
        F.col("doc_id").alias("ordinal"),
        (F.col("doc_id") % 50 == 0).alias("protected"),
        F.col("source").alias("organism"),
        F.col("text").alias("description"),
        F.col("text").alias("seq"),
        F.length("text").cast("bigint").alias("length"),
        F.col("lang").alias("strain"),
        F.lit(None).cast("string").alias("host"),
    )


RECORDS_SQL = """records AS (
  SELECT lang AS family, source AS species,
         (CASE WHEN doc_id % 50 = 0 THEN 'NC_' ELSE 'DOC' END) || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS accession,
         doc_id AS ordinal, doc_id % 50 = 0 AS protected, source AS organism, text AS description,
         text AS seq, CAST(length(text) AS BIGINT) AS length, lang AS strain, CAST(NULL AS VARCHAR) AS host
  FROM documents)"""

"""Append-only ledger of downloads and the plan of what still has to be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scale import keep_first

LEDGER_SCHEMA = (
    "request_key STRING, taxid BIGINT, db STRING, region STRING, segment STRING, max_per_species INT, "
    "marker_hash STRING, downloaded TIMESTAMP, n_records INT, size_bytes BIGINT, family STRING, is_empty BOOLEAN"
)


def marker_set_hash(markers: DataFrame) -> DataFrame:
    """Eight hex digits per family over all fields that change what is fetched; order counts."""
    subfamilies = F.array_sort(F.map_entries(F.coalesce("sub_aliases", F.create_map().cast("map<string,array<string>>"))))
    fields = F.struct(
        "marker_order",
        F.coalesce("name", F.lit("")).alias("name"),
        "aliases",
        subfamilies.alias("subfamilies"),
        F.array("len_min", "len_max").alias("length"),
        F.coalesce("locus_tag_hint", F.lit("")).alias("hint"),
    )
    spec = F.to_json(F.array_sort(F.collect_list(fields)))
    return markers.groupBy("family").agg(F.substring(F.sha2(spec, 256), 1, 8).alias("marker_hash"))


def concat_request_key(taxid: Column, marker_hash: Column, max_rows: Column) -> Column:
    return F.concat_ws("_", F.concat(F.lit("txid"), taxid), F.lit("concat"), F.concat(F.lit("marker"), marker_hash), max_rows.cast("string"))


def latest_entries(ledger: DataFrame) -> DataFrame:
    """The newest entry per request, positive and negative ones apart."""
    return keep_first(ledger, ["request_key", "is_empty"], [F.desc("downloaded"), F.desc("size_bytes"), F.desc_nulls_last("family")])


def valid_entries(ledger: DataFrame, now: Column, ttl_days: int | None = None) -> DataFrame:
    """Newest entries that still count: young enough, and with a payload unless negative."""
    fresh = F.lit(True) if ttl_days is None else F.col("downloaded") >= now - F.make_interval(days=F.lit(ttl_days))
    usable = F.col("is_empty") | (F.col("size_bytes") > 0)
    return latest_entries(ledger).filter(fresh & usable)


def misses(requests: DataFrame, ledger: DataFrame, now: Column, ttl_days: int | None = None) -> DataFrame:
    """Requests without any valid entry."""
    return requests.join(valid_entries(ledger, now, ttl_days).select("request_key"), "request_key", "left_anti")


def hits(requests: DataFrame, ledger: DataFrame, now: Column, ttl_days: int | None = None) -> DataFrame:
    """Requests answered by the ledger and how: positive or negative."""
    valid = valid_entries(ledger, now, ttl_days)
    answer = valid.groupBy("request_key").agg(F.min("is_empty").alias("negative"))
    return requests.join(answer, "request_key")


def without_family(ledger: DataFrame, family: str) -> DataFrame:
    """The ledger without one family; entries of no family stay."""
    return ledger.filter(~F.col("family").eqNullSafe(F.lit(family)))


def without_requests(ledger: DataFrame, requests: DataFrame) -> DataFrame:
    return ledger.join(requests.select("request_key"), "request_key", "left_anti")


def stats(ledger: DataFrame) -> DataFrame:
    """Entries, negative entries and size in MB at one decimal, over the newest entries."""
    return latest_entries(ledger).agg(
        F.count_if(~F.col("is_empty")).alias("entries"),
        F.count_if("is_empty").alias("empty_entries"),
        F.bround(F.coalesce(F.sum(F.when(~F.col("is_empty"), F.col("size_bytes"))), F.lit(0)) / F.lit(1048576.0), 1).alias("size_mb"),
    )

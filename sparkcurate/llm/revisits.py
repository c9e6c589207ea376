"""Not-modified revisits of web archives: an as-of join to the latest earlier full response.

A revisit (status 304) carries no body. It is resolved to the latest full response (status 200) of the
same canonical URL that was captured strictly before it. The validators decide whether that response is
the one the server meant: entity tags are compared weakly (the W/ mark is ignored); where one side has
none, the modification dates are compared; where that fails too, the payload digests. A resolved revisit
gets the headers of the response, updated by those that a 304 may change (RFC 9110, 15.4.5).

verdict: "resolved"; "mismatch" (the validators differ); "unverified" (no validator on both sides);
"no response" (none earlier, or no URL).

Scale: only narrow rows take part, payloads stay where they are. The time range is cut into `slots`
slices. The last response of each (URL, slice) is an aggregate that combines map-side; what a slice
inherits from earlier ones is a running value over at most `slots` rows of a URL; inside a slice rows
are ordered by a window. So a URL that holds a third of all captures is spread over many tasks.

Edge cases: a null URL has no response; responses of one instant: the greatest record id counts; repeated
rows are resolved each; null headers count as empty, names are compared in lower case; records of other
statuses take no part; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

#: Headers that a 304 response may update (fixed by RFC 9110).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't choose content.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)(=|$)"
SLOTS = 256


def canonical_url(url: Column) -> Column:
    """Without scheme, user, "www.", default port, fragment, tracking parameters and trailing slashes.

    The host is in lower case and the remaining parameters are sorted. Null and blank URLs give null.
    """
    bare = F.regexp_replace(F.trim(url), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, "#.*$", "")
    host = F.lower(F.regexp_extract(bare, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", ""), "^www\\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    parameters = F.filter(
        F.split(F.regexp_extract(bare, "\\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(parameters), "&")
    joined = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(F.length(F.trim(url)) > 0, joined)


def _lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that differ in case only, the least spelling's value counts."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    merged = F.aggregate(
        entries, F.create_map().cast("map<string,string>"),
        lambda acc, e: F.when(F.map_contains_key(acc, F.lower(e["key"])), acc).otherwise(
            F.map_concat(acc, F.create_map(F.lower(e["key"]), e["value"]))))
    return merged


def _tag(headers: Column) -> Column:
    return F.regexp_replace(F.trim(headers["etag"]), "^W/", "")


def resolve_revisits(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """records: record_id, url, captured_at (any orderable number or time), status, headers map, payload_digest.

    Returns one row per revisit: record_id, canonical_url, captured_at, response_id, verdict, headers
    (merged if resolved, else its own) and payload_digest (of the response if resolved, else null).
    """
    scratch = Scratch(records.sparkSession)
    slim = scratch.store(records.filter(F.col("status").isin(200, 304)).select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), "captured_at",
        F.col("captured_at").cast("double").alias("at"), (F.col("status") == 200).alias("full"),
        _lower_keys(F.col("headers")).alias("headers"), "payload_digest"))
    span = slim.agg(F.min("at").alias("low"), F.max("at").alias("high")).first()
    low, width = span["low"] or 0.0, ((span["high"] or 0.0) - (span["low"] or 0.0)) / slots
    slot = F.floor((F.col("at") - low) / width) if width > 0 else F.lit(0)
    placed = slim.withColumn("slot", slot.cast("bigint"))
    found = F.struct("at", F.col("record_id").alias("id"), "headers_list", "payload_digest")
    # Maps don't compare, so headers travel as sorted entries.
    placed = scratch.store(placed.withColumn("headers_list", F.array_sort(F.map_entries("headers"))).drop("headers"))
    responses = placed.filter(F.col("full") & F.col("canonical_url").isNotNull())
    last = responses.groupBy("canonical_url", "slot").agg(F.max(found).alias("last"))
    revisits = placed.filter(~F.col("full"))
    # Every slice that holds revisits or responses, with the last response before the slice.
    slices = last.unionByName(
        revisits.filter(F.col("canonical_url").isNotNull()).select("canonical_url", "slot").distinct().withColumn(
            "last", F.lit(None).cast(last.schema["last"].dataType)))
    slices = slices.groupBy("canonical_url", "slot").agg(F.max("last").alias("last"))
    before = W.partitionBy("canonical_url").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    inherited = slices.withColumn("inherited", F.last("last", ignorenulls=True).over(before)).drop("last")
    # Inside a slice: rows in order of time, responses of an instant after its revisits.
    inside = W.partitionBy("canonical_url", "slot").orderBy("at", "full", "record_id").rowsBetween(
        W.unboundedPreceding, -1)
    local = placed.filter(F.col("canonical_url").isNotNull()).withColumn(
        "local", F.last(F.when(F.col("full"), found), ignorenulls=True).over(inside)).filter(~F.col("full"))
    known = local.join(inherited, ["canonical_url", "slot"], "left").withColumn(
        "response", F.coalesce("local", "inherited")).drop("local", "inherited")
    lost = revisits.filter(F.col("canonical_url").isNull()).withColumn(
        "response", F.lit(None).cast(known.schema["response"].dataType))
    return _judge(known.unionByName(lost))


def _judge(rows: DataFrame) -> DataFrame:
    """Check the validators and merge the headers."""
    rows = rows.withColumn("own", F.map_from_entries("headers_list")).withColumn(
        "stored", F.map_from_entries("response.headers_list"))
    answers = []
    for mine, theirs in (
        (_tag(F.col("own")), _tag(F.col("stored"))),
        (F.col("own")["last-modified"], F.col("stored")["last-modified"]),
        (F.col("payload_digest"), F.col("response.payload_digest")),
    ):
        answers.append(F.when(mine.isNotNull() & theirs.isNotNull(), mine == theirs))
    agreed = F.coalesce(*answers)
    verdict = F.when(F.col("response").isNull(), "no response").when(agreed.isNull(), "unverified").when(
        agreed, "resolved").otherwise("mismatch")
    fresh = F.map_filter("own", lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter("stored", lambda k, _: ~F.map_contains_key(fresh, k))
    resolved = F.col("verdict") == "resolved"
    return rows.withColumn("verdict", verdict).select(
        "record_id", "canonical_url", "captured_at", F.col("response.id").alias("response_id"), "verdict",
        F.when(resolved, F.map_concat(kept, fresh)).otherwise(F.col("own")).alias("headers"),
        F.when(resolved, F.col("response.payload_digest")).alias("payload_digest"))

"""The queries of the corpus operators over the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stable_folder
from . import (
    alignment,
    decontamination,
    linkgraph,
    merkle,
    mixing,
    phrases,
    quality,
    revisits,
    sharding,
    simhash,
    suffixes,
    tokens,
    toxicity,
)
from .common import Scratch


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    packed = sharding.shard_documents(docs, ["doc_id"], ["doc_id"], shards=16)
    return packed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return quality.reject_outliers(docs, ["doc_id"])


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic").filter(~toxicity.held_out())
    rules = toxicity.ToxicityRules()
    model = toxicity.train(docs, labels, rules, Scratch(spark))
    scored = toxicity.score_documents(docs, ["doc_id"], model, rules)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    items = table(spark, folder, "benchmark").select("item_id", "text")
    return decontamination.find_leaks(docs, items, ["doc_id"])


def captures(pages: DataFrame) -> DataFrame:
    """pages as archive records: each page is a full response, and a later crawl of it finds it not modified.

    The later crawl comes up to 5,000 pages after, so another capture of the same canonical URL may lie
    between. One crawl in five knows no entity tag but the modification date.
    """
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    day = F.concat(F.lit("day "), (F.col("page_id") % 50).cast("string"))
    response = pages.select(
        (2 * F.col("page_id")).alias("record_id"), "url", (2 * F.col("page_id")).alias("captured_at"),
        F.lit(200).alias("status"),
        F.create_map(F.lit("ETag"), tag, F.lit("Last-Modified"), day, F.lit("Content-Type"), F.lit("text/html"),
                     F.lit("Date"), (2 * F.col("page_id")).cast("string")).alias("headers"),
        F.md5(F.coalesce("html", F.lit(""))).alias("payload_digest"))
    later = 2 * F.col("page_id") + 1 + 2 * (F.col("page_id") * 37 % 5000)
    with_tag = F.create_map(F.lit("etag"), F.concat(F.lit("W/"), tag), F.lit("date"), later.cast("string"),
                            F.lit("content-type"), F.lit("none"))
    with_day = F.create_map(F.lit("last-modified"), day, F.lit("date"), later.cast("string"))
    revisit = pages.select(
        (2 * F.col("page_id") + 1).alias("record_id"), "url", later.alias("captured_at"), F.lit(304).alias("status"),
        F.when(F.col("page_id") % 5 == 0, with_day).otherwise(with_tag).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"))
    return response.unionByName(revisit)


def op5_revisits(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = revisits.resolve_revisits(captures(pages))
    return found.select(
        "record_id", "canonical_url", "captured_at", "response_id", "verdict",
        F.col("headers")["etag"].alias("etag"), F.col("headers")["last-modified"].alias("last_modified"),
        F.col("headers")["content-type"].alias("content_type"), F.col("headers")["date"].alias("date"),
        "payload_digest")


OP5_SQL = r"""
WITH parts AS (
  SELECT page_id, html, trim(url) AS url,
         regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS bare
  FROM pages),
cut AS (
  SELECT page_id, html, url,
         regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^.*@', ''),
                                       ':(80|443)$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)(=|$)'))), '&') AS query
  FROM parts),
canon AS (
  SELECT page_id, coalesce(html, '') AS html,
         CASE WHEN length(url) > 0 THEN host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS curl
  FROM cut),
responses AS (
  SELECT 2 * page_id AS id, curl, 2 * page_id AS ts, '"' || md5(html) || '"' AS tag, 'day ' || (page_id % 50) AS day,
         md5(html) AS digest
  FROM canon WHERE curl IS NOT NULL),
revisits AS (
  SELECT 2 * page_id + 1 AS id, curl, 2 * page_id + 1 + 2 * (page_id * 37 % 5000) AS ts,
         CASE WHEN page_id % 5 <> 0 THEN '"' || md5(html) || '"' END AS tag,
         CASE WHEN page_id % 5 = 0 THEN 'day ' || (page_id % 50) END AS day
  FROM canon),
latest AS (
  SELECT v.id AS vid, max(struct_pack(ts := r.ts, id := r.id, tag := r.tag, day := r.day, digest := r.digest)) AS r
  FROM revisits v JOIN responses r ON v.curl = r.curl AND r.ts < v.ts GROUP BY v.id),
judged AS (
  SELECT v.*, l.r AS r,
         CASE WHEN l.r IS NULL THEN 'no response'
              WHEN coalesce(v.tag = l.r.tag, v.day = l.r.day) THEN 'resolved' ELSE 'mismatch' END AS verdict
  FROM revisits v LEFT JOIN latest l ON v.id = l.vid)
SELECT id AS record_id, curl AS canonical_url, ts AS captured_at, r.id AS response_id, verdict,
       CASE WHEN tag IS NOT NULL THEN 'W/' || tag WHEN verdict = 'resolved' THEN r.tag END AS etag,
       CASE WHEN day IS NOT NULL THEN day WHEN verdict = 'resolved' THEN r.day END AS last_modified,
       CASE WHEN verdict = 'resolved' THEN 'text/html' WHEN tag IS NOT NULL THEN 'none' END AS content_type,
       CAST(ts AS VARCHAR) AS date,
       CASE WHEN verdict = 'resolved' THEN r.digest END AS payload_digest
FROM judged"""


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cache = stable_folder(spark, "token-cache")  # found again by the next run
    counted = tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), cache)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs, ["doc_id"], ["doc_id"])


def op8_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.remove_phrases(table(spark, folder, "documents").select("doc_id", "text"), ["doc_id"])


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, "doc_id", shingle=3, bits=2)


def op10_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"), ["doc_id"])


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(
        table(spark, folder, "documents").select("doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])


#: (action, host, path)
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op12_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return linkgraph.judge_urls(pages, linkgraph.rule_table(spark, URL_RULES), ["page_id"])


def _rounds(name: str, source: str, target: str, seed: str) -> str:
    """The rounds of one value as a chain of CTEs; the last is `name`."""
    first = f"""
{name}_edges AS (
  SELECT {source} AS source, {target} AS target, n, sum(n) OVER (PARTITION BY {source}) AS total FROM edges),
{name}_own AS (
  SELECT host, CAST(floor({seed} * {linkgraph.SCALE} * (1 - CAST(0.85 AS DOUBLE))) AS BIGINT) AS value FROM seeds WHERE {seed} > 0),
{name}_0 AS (SELECT * FROM {name}_own),"""
    rounds = [f"""
{name}_{i + 1} AS (
  SELECT host, CAST(sum(value) AS BIGINT) AS value FROM (
    SELECT host, value FROM {name}_own
    UNION ALL SELECT target, CAST(floor(value * (CAST(0.85 AS DOUBLE) * n / total)) AS BIGINT)
              FROM {name}_{i} JOIN {name}_edges ON host = source) GROUP BY host),""" for i in range(linkgraph.GraphRules().rounds)]
    return "".join([first, *rounds])


OP12_SQL = rf"""
WITH cut AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(action, rule_host, rule_path) AS (
  VALUES {", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in URL_RULES)}),
best AS (
  SELECT host, path, max(struct_pack(size := length(rule_host || rule_path), blocks := action = 'block',
                                     rule := rule_host || rule_path, action := action)) AS b
  FROM cut JOIN rules ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
  GROUP BY host, path),
ruled AS (SELECT c.*, b.b.rule AS rule, b.b.action AS action FROM cut c LEFT JOIN best b ON c.host = b.host AND c.path = b.path),
seeds AS (
  SELECT host, count(*) FILTER (action = 'allow') AS allowed, count(*) FILTER (action = 'block') AS blocked
  FROM ruled WHERE rule IS NOT NULL GROUP BY host),
links AS (
  SELECT host AS src, html, 'http:' || regexp_replace(unnest(regexp_extract_all(coalesce(html, ''),
    '(?is)<a(?:rea)?\s[^<>]*?\bhref\s*=\s*["'']?\s*((?:https?:)?//[^\s"''<>]+)', 1)), '^https?:', '', 'i') AS link
  FROM cut WHERE host <> ''),
targets AS (
  SELECT DISTINCT src, html, translate(regexp_extract(link, '(?s)^.*?://([^/?#]*)', 1),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM links),
edges AS (SELECT src, dst, count(*) AS n FROM targets WHERE src <> dst AND dst <> '' GROUP BY src, dst),
{_rounds("trust", "src", "dst", "allowed")}
{_rounds("distrust", "dst", "src", "blocked")}
scores AS (
  SELECT host, sum(t) / {linkgraph.SCALE} AS trust, sum(d) / {linkgraph.SCALE} AS distrust
  FROM (SELECT host, value AS t, 0 AS d FROM trust_20 UNION ALL SELECT host, 0, value FROM distrust_20) GROUP BY host)
SELECT page_id, r.host, path, rule,
       coalesce(action, CASE WHEN distrust > trust THEN 'block' ELSE 'allow' END) AS verdict, trust, distrust
FROM ruled r LEFT JOIN scores s ON r.host = s.host"""


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    return merkle.document_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", ["doc_id"], tampered)


OP13_SQL = """
WITH RECURSIVE cells AS (
  SELECT row_number() OVER () AS rn, doc_id, lang AS g, text,
         concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                   coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
             lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda crc, e: CASE WHEN e >= 0 THEN xor(crc, e) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END) AS crc
  FROM documents),
leaves AS (
  SELECT rn, doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-'))
              ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS told
  FROM cells),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
nodes AS (
  SELECT g, 0 AS lv, pos, n, leaf AS d FROM placed
  UNION ALL
  SELECT g, lv + 1, pos // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY g, lv, pos // 8, n),
subroots AS MATERIALIZED (
  SELECT g, d, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lv, pos, n, d FROM subroots
  UNION ALL
  SELECT lv + 1, pos // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lv, pos // 8, n),
runs AS MATERIALIZED (SELECT g, lv, pos // 8 AS r, list(d ORDER BY pos) AS ds FROM nodes WHERE n > 1 GROUP BY g, lv, pos // 8),
top_runs AS MATERIALIZED (SELECT lv, pos // 8 AS r, list(d ORDER BY pos) AS ds FROM tops WHERE n > 1 GROUP BY lv, pos // 8),
lower_fold AS (
  SELECT rn, g, 0 AS lv, pos, told AS cur, '' AS proof FROM placed
  UNION ALL
  SELECT rn, f.g, f.lv + 1, pos // 8, sha256(array_to_string(ds[1:pos % 8] || [cur] || ds[pos % 8 + 2:], '')),
         proof || array_to_string(ds[1:pos % 8] || ds[pos % 8 + 2:], '')
  FROM lower_fold f JOIN runs ON f.g IS NOT DISTINCT FROM runs.g AND f.lv = runs.lv AND f.pos // 8 = runs.r),
upper_fold AS (
  SELECT rn, 0 AS lv, s.pos, f.cur, f.proof
  FROM (SELECT rn, g, arg_max(cur, lv) AS cur, arg_max(proof, lv) AS proof FROM lower_fold GROUP BY rn, g) f
  JOIN subroots s ON f.g IS NOT DISTINCT FROM s.g
  UNION ALL
  SELECT rn, f.lv + 1, pos // 8, sha256(array_to_string(ds[1:pos % 8] || [cur] || ds[pos % 8 + 2:], '')),
         proof || array_to_string(ds[1:pos % 8] || ds[pos % 8 + 2:], '')
  FROM upper_fold f JOIN top_runs ON f.lv = top_runs.lv AND f.pos // 8 = top_runs.r),
folded AS (SELECT rn, arg_max(cur, lv) AS cur, arg_max(proof, lv) AS proof FROM upper_fold GROUP BY rn)
SELECT doc_id, leaf, s.d AS subroot, t.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = t.d AS verified
FROM placed p JOIN folded USING (rn) JOIN subroots s ON p.g IS NOT DISTINCT FROM s.g JOIN (SELECT d FROM tops WHERE n = 1) t ON true"""


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_revisits": op5_revisits,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_phrases": op8_phrases,
    "op9_simhash": op9_simhash,
    "op10_suffixes": op10_suffixes,
    "op11_alignment": op11_alignment,
    "op12_url_filters": op12_url_filters,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {"op5_revisits": OP5_SQL, "op12_url_filters": OP12_SQL,
                           "op13_merkle": OP13_SQL}

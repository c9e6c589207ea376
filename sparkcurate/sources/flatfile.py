"""Flat-file and FASTA sources and sinks. Files are split by record terminator, so
one large file is read by many tasks; all parsing is done by Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import marker_slug, source_metadata


def _field(block: Column, name: str) -> Column:
    """Header field with its continuation lines joined by blanks."""
    raw = F.regexp_extract(block, rf"(?m)^{name} +(.*(?:\n {{12}}.*)*)", 1)
    return F.trim(F.regexp_replace(raw, r"\s*\n +", " "))


def _feature(text: Column) -> Column:
    pattern = F.lit(r"\n {21}/(\w+)(?:=(\"(?:[^\"]|\"\")*\"|[^\n]*))?")
    keys = F.regexp_extract_all(text, pattern, F.lit(1))
    values = F.transform(
        F.regexp_extract_all(text, pattern, F.lit(2)),
        lambda v: F.regexp_replace(F.regexp_replace(F.regexp_replace(v, '^"|"$', ""), r"\n\s*", " "), '""', '"'),
    )
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    names = F.array_distinct(keys)
    grouped = F.transform(
        names, lambda n: F.transform(F.filter(pairs, lambda p: p["k"] == n), lambda p: p["v"])
    )
    return F.struct(F.regexp_extract(text, r"^\s*(\S+)", 1).alias("type"), F.map_from_arrays(names, grouped).alias("qualifiers"))


def _drop_period(text: Column) -> Column:
    return F.regexp_replace(text, r"\.$", "")


def parse_flat_records(blocks: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per flat-file block: header fields, lineage, features and sequence."""
    block = F.concat(F.lit("\n"), F.col(column))
    head = F.regexp_extract(block, r"(?s)^(.*?)(?:\nFEATURES|\nORIGIN|$)", 1)
    table = F.regexp_extract(block, r"(?s)\nFEATURES[^\n]*(.*?)(?:\nORIGIN|$)", 1)
    origin = F.regexp_extract(block, r"(?s)\nORIGIN[^\n]*\n(.*)$", 1)
    raw = blocks.select(*keep, head.alias("head"), table.alias("table"), origin.alias("origin"))
    h = F.col("head")
    lineage = F.trim(
        F.regexp_replace(F.regexp_extract(h, r"(?m)^  ORGANISM .*((?:\n {12}.*)+)", 1), r"\s*\n +", " ")
    )
    parts = F.split(F.regexp_replace(F.col("table"), r"^\s*\n", "\n"), r"\n {5}(?=\S)")
    features = F.transform(F.filter(parts, lambda t: F.length(F.trim(t)) > 0), _feature)
    letters = F.upper(F.regexp_replace("origin", "[^A-Za-z]", ""))
    version = F.coalesce(F.nullif(F.regexp_extract(h, r"(?m)^VERSION +(\S+)", 1), F.lit("")), F.regexp_extract(h, r"(?m)^ACCESSION +(\S+)", 1))
    return raw.select(
        *keep,
        version.alias("accession"),
        _drop_period(_field(h, "DEFINITION")).alias("description"),
        F.regexp_extract(h, r"(?m)^  ORGANISM +(.*)", 1).alias("organism"),
        _field(h, "SOURCE").alias("source"),
        _field(h, "DBSOURCE").alias("db_source"),
        F.filter(F.split(_drop_period(lineage), r";\s*"), lambda n: n != "").alias("lineage"),
        features.alias("features"),
        F.nullif(letters, F.lit("")).alias("seq"),
    ).withColumn("length", F.length("seq"))


def with_metadata(records: DataFrame) -> DataFrame:
    return records.withColumns(source_metadata(F.col("organism"), F.col("features")))


# A record ends with a line of two slashes; what follows on it (a carriage return) goes with the next part.
RECORD_END = "\n//"


def flat_blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return record_blocks(spark.read.option("lineSep", RECORD_END).text(path))


def record_blocks(parts: DataFrame) -> DataFrame:
    """Texts between end marks as records with plain line ends; blank ones dropped."""
    plain = F.regexp_replace(F.regexp_replace("value", "\r", ""), "^\n+", "")
    return parts.withColumn("value", plain).filter(F.length(F.trim(F.regexp_replace("value", "\n|//", ""))) > 0)


def read_flat_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_flat_records(flat_blocks(spark, path))


def read_marker_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All per-marker files of a folder in one read; `slug` tells the marker."""
    blocks = flat_blocks(spark, folder).withColumn("slug", F.regexp_extract("_metadata.file_path", r"([^/]+)\.gb$", 1))
    return parse_flat_records(blocks, keep=["slug"])


def marker_folder_counts(proteins: DataFrame, markers: DataFrame) -> DataFrame:
    """Records per marker; absent and empty files count as zero."""
    counts = proteins.groupBy("slug").agg(F.count(F.lit(1)).alias("n_records"))
    return (
        markers.withColumn("slug", marker_slug(F.col("name"))).join(counts, "slug", "left").fillna(0, ["n_records"])
    )


def parse_fasta(entries: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """id, description, seq of each FASTA entry (text after or with its ">")."""
    body = F.regexp_replace(F.col(column), "^>", "")
    title = F.regexp_extract(body, r"^([^\n]*)", 1)
    return entries.select(
        *keep,
        F.regexp_extract(title, r"^(\S*)", 1).alias("id"),
        title.alias("description"),
        F.regexp_replace(F.regexp_replace(body, r"^[^\n]*", ""), r"\s", "").alias("seq"),
    ).filter(F.col("id") != "")


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_fasta(spark.read.option("lineSep", "\n>").text(path))


def write_fasta(df: DataFrame, path: str, identifier: str = "id", seq: str = "seq", partitions: Sequence[str] = ()) -> None:
    entry = F.concat(F.lit(">"), F.col(identifier), F.lit("\n"), F.col(seq))
    writer = df.select(entry.alias("value"), *partitions).write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).text(path)

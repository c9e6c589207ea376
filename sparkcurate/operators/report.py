"""Family summary, status and progress tables, and leaf properties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import known
from ..functions.taxa import name_at_rank
from ..functions.text import lineage_string, molecule_region, year_of
from ..sources.tables import summary_columns


def annotate_families(families: DataFrame, annotations: DataFrame | None, columns: Sequence[str] = ("baltimore_class",)) -> DataFrame:
    """Annotation columns by family name, case-insensitive; "" where there is none."""
    if annotations is None:
        return families.withColumns({c: F.lit("") for c in columns})
    keyed = families.withColumn("family_key", F.lower("family"))
    joined = keyed.join(annotations.select("family_key", *columns), "family_key", "left").drop("family_key")
    return joined.withColumns({c: F.coalesce(F.trim(c), F.lit("")) for c in columns})


def long_stats(df: DataFrame, keys: Sequence[str], prefix: str = "") -> DataFrame:
    """Wide statistics to (keys, key, value) rows with text values."""
    values = [c for c in df.columns if c not in keys]
    text = df.select(*keys, *[F.col(c).cast("string").alias(f"{prefix}{c}") for c in values])
    return text.unpivot(list(keys), [f"{prefix}{c}" for c in values], "key", "value")


def summary_rows(families: DataFrame, family_stats: DataFrame, target_stats: DataFrame) -> DataFrame:
    """One wide row per family.

    families: family, ncbi_taxid, lineage (names), baltimore_class, molecule, region,
    segment. family_stats: family, key, value. target_stats: family, target, key,
    value. All statistics are folded in one aggregation.
    """
    base = families.select(
        "family",
        F.col("ncbi_taxid").cast("string").alias("ncbi_taxid"),
        lineage_string(F.col("lineage")).alias("lineage"),
        "baltimore_class",
        molecule_region(F.col("molecule"), F.col("region"), F.col("segment")).alias("molecule_region"),
    )
    prefixed = target_stats.select("family", F.concat(F.lit("tree"), F.col("target").cast("string"), F.lit("_"), F.col("key")).alias("key"), "value")
    columns = summary_columns()
    wanted = [c for c in columns if c not in base.columns]
    stats = family_stats.select("family", "key", "value").unionByName(prefixed)
    wide = stats.groupBy("family").agg(*[F.max(F.when(F.col("key") == c, F.col("value"))).alias(c) for c in wanted])
    return base.join(wide, "family", "left").select(*columns)


def status_rows(families: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Status per requested family: OK, or the reason it was skipped."""
    joined = families.join(outcomes.select("family", "reason"), "family", "left")
    return joined.select(
        "family",
        F.col("ncbi_taxid").cast("string").alias("ncbi_taxid"),
        molecule_region(F.col("molecule"), F.col("region"), F.col("segment")).alias("molecule_region"),
        F.coalesce("reason", F.lit("OK")).alias("status"),
        lineage_string(F.col("lineage")).alias("lineage"),
        "baltimore_class",
    )


def progress_board(requested: DataFrame, status: DataFrame) -> DataFrame:
    """family, state (pending, done, skipped), note."""
    joined = requested.join(status.select("family", "status"), "family", "left")
    state = F.when(F.col("status").isNull(), "pending").when(F.col("status") == "OK", "done").otherwise("skipped")
    note = F.when(state == "skipped", F.col("status")).otherwise("")
    return joined.select("family", state.alias("state"), note.alias("note"))


def progress_counts(board: DataFrame) -> DataFrame:
    return board.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def leaf_properties(leaves: DataFrame, keys: Sequence[str], ranked: Column | None = None) -> DataFrame:
    """(keys, property, value) rows of the known metadata of each leaf."""
    lineage = ranked if ranked is not None else F.col("lineage_ranked")
    wide = leaves.select(
        *keys,
        known(F.col("host")).alias("Host"),
        known(F.col("collection_date")).alias("Collection_Date"),
        known(F.col("location")).alias("Location"),
        known(F.col("strain")).alias("Strain"),
        F.nullif(year_of(F.col("collection_date")), F.lit("")).alias("Year"),
        known(F.col("species")).alias("Species"),
        name_at_rank(lineage, "genus").alias("Genus"),
        name_at_rank(lineage, "subgenus").alias("Subgenus"),
        name_at_rank(lineage, "subfamily").alias("Subfamily"),
    )
    names = [c for c in wide.columns if c not in keys]
    return wide.unpivot(list(keys), names, "property", "value").filter(F.col("value").isNotNull())

"""Marker identification and assembly of multi-part genomes from single proteins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ids import is_protected_id
from .scale import small_side

Matcher = Callable[[Column, Column], Column]


def name_text(description: Column, features: Column) -> Column:
    """Text searched for marker names: description plus product and name qualifiers."""
    wanted = F.filter(features, lambda f: f["type"].isin("Protein", "CDS"))
    none = F.array().cast("array<string>")
    names = F.flatten(
        F.transform(
            wanted,
            lambda f: F.concat(F.coalesce(f["qualifiers"]["product"], none), F.coalesce(f["qualifiers"]["name"], none)),
        )
    )
    described = F.when(F.length(description) > 0, F.array(description)).otherwise(none)
    return F.array_join(F.concat(described, F.coalesce(names, none)), " ")


def effective_names(subfamily: Column) -> Column:
    """Name, aliases and the aliases of the row's own subfamily (marker columns in scope)."""
    none = F.array().cast("array<string>")
    extra = F.coalesce(F.try_element_at(F.col("sub_aliases"), F.coalesce(subfamily, F.lit(""))), none)
    return F.concat(F.array("name"), F.coalesce(F.col("aliases"), none), extra)


def contains_a_name(text: Column, names: Column) -> Column:
    """Both sides are in lower case already."""
    return F.exists(names, lambda n: (F.length(n) > 0) & F.contains(text, n))


def match_markers(proteins: DataFrame, markers: DataFrame, matcher: Matcher = contains_a_name) -> DataFrame:
    """Every (protein, marker) that matches; markers meet only proteins of their family.

    proteins: family, genome_id, accession, text, length, locus_tag, subfamily, ...
    markers: family, marker_order, name, aliases, sub_aliases, len_min, len_max, locus_tag_hint.
    The matcher gets texts and names in lower case, prepared once per row of each side.
    """
    subfamilies = proteins.select("family", "subfamily").distinct()
    by_subfamily = subfamilies.join(markers, "family").withColumn(
        "__names", F.transform(effective_names(F.col("subfamily")), F.lower)
    )
    by_subfamily = small_side(by_subfamily.withColumnsRenamed({"family": "__family", "subfamily": "__subfamily"}))
    same = F.col("family").eqNullSafe(F.col("__family")) & F.col("subfamily").eqNullSafe(F.col("__subfamily"))
    joined = proteins.withColumn("__low", F.lower("text")).join(by_subfamily, same)
    matched = joined.filter(matcher(F.col("__low"), F.col("__names")))
    return matched.drop("__low", "__names", "__family", "__subfamily")


def choose_proteins(matched: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One protein per genome and marker.

    Candidates whose locus tag matches the hint come first; then the length nearest
    to the middle of the range when there is one, else the longest; then the id.
    A minimum of structs, so copies are reduced before the shuffle.
    """
    hint = F.col("locus_tag_hint")
    hit = F.when(F.length(hint) > 0, F.rlike(F.coalesce("locus_tag", F.lit("")), F.concat(F.lit("(?i)"), hint))).otherwise(False)
    middle = (F.col("len_min") + F.col("len_max")) / F.lit(2.0)
    fit = F.when(middle.isNotNull(), F.abs(F.col("length") - middle)).otherwise(-F.col("length").cast("double"))
    best = F.min(F.struct((~hit).alias("miss"), fit.alias("fit"), F.coalesce("accession", F.lit("")).alias("accession"), "length", *keep))
    chosen = matched.groupBy("family", "genome_id", F.col("name").alias("marker"), "marker_order").agg(best.alias("b"))
    return chosen.select(
        "family", "genome_id", "marker", "marker_order", *[F.col(f"b.{c}").alias(c) for c in ("accession", "length", *keep)]
    )


def identify_markers(
    proteins: DataFrame, markers: DataFrame, matcher: Matcher = contains_a_name, keep: tuple[str, ...] = ()
) -> DataFrame:
    return choose_proteins(match_markers(proteins, markers, matcher), keep)


def required_markers(markers: DataFrame, min_fraction: float) -> DataFrame:
    """Markers a genome must cover: the share rounded half-even, at least one."""
    n = F.count_distinct("name")
    return markers.groupBy("family").agg(
        n.alias("n_markers"), F.greatest(F.lit(1), F.bround(F.lit(min_fraction) * n, 0).cast("int")).alias("n_required")
    )


def covered_genomes(chosen: DataFrame, markers: DataFrame, min_fraction: float) -> DataFrame:
    """family, genome_id, n_covered, kept."""
    counts = chosen.groupBy("family", "genome_id").agg(F.count(F.lit(1)).alias("n_covered"))
    return counts.join(required_markers(markers, min_fraction), "family").select(
        "family", "genome_id", "n_covered", (F.col("n_covered") >= F.col("n_required")).alias("kept")
    )


def assemble(
    proteins: DataFrame, markers: DataFrame, min_fraction: float = 0.7, matcher: Matcher = contains_a_name, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Chosen proteins of the genomes that cover enough markers."""
    with_source = proteins.filter(F.length("genome_id") > 0)
    chosen = identify_markers(with_source, markers, matcher, keep)
    # at most one row per marker is left in a genome, so this window is bounded
    covered = F.count(F.lit(1)).over(W.partitionBy("family", "genome_id"))
    needed = small_side(required_markers(markers, min_fraction).select("family", "n_required"))
    return (
        chosen.withColumn("__n", covered).join(needed, "family").filter(F.col("__n") >= F.col("n_required")).select(*chosen.columns)
    )


def split_submissions(proteins: DataFrame, group: list[str]) -> DataFrame:
    """Isolates whose first mention appears in two genomes or more, counted per group."""
    first = F.min(F.struct("ordinal", "isolate"))
    named = proteins.filter((F.length("genome_id") > 0) & (F.length("isolate") > 0))
    isolate = named.groupBy(*group, "genome_id").agg(first.alias("f")).select(*group, F.col("f.isolate").alias("isolate"))
    shared = isolate.groupBy(*group, "isolate").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return shared.groupBy(*group).agg(F.count(F.lit(1)).alias("n_split"))


def assembly_counters(
    proteins: DataFrame, markers: DataFrame, min_fraction: float = 0.7, matcher: Matcher = contains_a_name
) -> DataFrame:
    """Per family: proteins, orphans, genomes found, kept and dropped, split isolates, protected kept."""
    base = proteins.groupBy("family").agg(
        F.count(F.lit(1)).alias("n_proteins"),
        F.count_if(~(F.length(F.coalesce("genome_id", F.lit(""))) > 0)).alias("n_orphans"),
        F.count_distinct(F.nullif("genome_id", F.lit(""))).alias("n_genomes_found"),
    )
    kept = assemble(proteins, markers, min_fraction, matcher).select("family", "genome_id").distinct()
    kept = kept.groupBy("family").agg(
        F.count(F.lit(1)).alias("n_genomes_kept"),
        F.count_if(is_protected_id(F.col("genome_id"))).alias("n_protected_kept"),
    )
    out = (
        base.join(required_markers(markers, min_fraction).drop("n_markers"), "family", "left")
        .join(kept, "family", "left")
        .join(split_submissions(proteins, ["family"]), "family", "left")
        .fillna(0, ["n_genomes_kept", "n_protected_kept", "n_split"])
    )
    return out.withColumn("n_dropped", F.col("n_genomes_found") - F.col("n_genomes_kept"))


def marker_coverage(chosen: DataFrame, markers: DataFrame) -> DataFrame:
    """Genomes per marker, markers without any included."""
    counts = chosen.groupBy("family", F.col("marker").alias("name")).agg(F.count(F.lit(1)).alias("n_genomes"))
    return (
        markers.select("family", "name", "marker_order")
        .join(counts, ["family", "name"], "left")
        .fillna(0, ["n_genomes"])
    )


def coverage_summary(coverage: DataFrame) -> DataFrame:
    """Markers wanted and used, and the "marker:n,..." string in marker order."""
    entry = F.struct("marker_order", F.concat_ws(":", "name", F.col("n_genomes").cast("string")).alias("text"))
    return coverage.groupBy("family").agg(
        F.count(F.lit(1)).alias("n_markers_target"),
        F.count_if(F.col("n_genomes") > 0).alias("n_markers_used"),
        F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"]), ",").alias("marker_coverage"),
    )


def restrict_genomes(genome_markers: DataFrame, selected: DataFrame) -> DataFrame:
    return genome_markers.join(selected, ["family", "genome_id"], "left_semi")


def genome_species(genome_markers: DataFrame) -> DataFrame:
    return genome_markers.select("family", "genome_id", "species").distinct()

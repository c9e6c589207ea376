"""Expressions over lineages: arrays of names, or of (name, rank) structs ordered root to tip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Depth of each rank, deeper is more specific.
RANK_DEPTH = {
    "realm": 1, "subrealm": 2, "kingdom": 3, "phylum": 4, "subphylum": 5,
    "class": 6, "order": 7, "family": 8, "subfamily": 9, "genus": 10,
    "subgenus": 11, "species": 12, "subspecies": 13, "strain": 14,
}

# Taxon name endings and the rank they stand for, first match wins.
RANK_SUFFIXES = [
    ("viricotina", "subphylum"),
    ("viricetes", "class"),
    ("viricota", "phylum"),
    ("virinae", "subfamily"),
    ("viridae", "family"),
    ("virales", "order"),
    ("virae", "kingdom"),
    ("viria", "realm"),
    ("vira", "subrealm"),
]

# Ranks at or below species.
SPECIES_OR_BELOW = ["species", "subspecies", "strain", "isolate", "serotype", "biotype", "genotype"]

# Ranks allowed by the phyloXML 1.20 schema.
SCHEMA_RANKS = [
    "domain",
    "superkingdom",
    "kingdom",
    "subkingdom",
    "branch",
    "infrakingdom",
    "superphylum",
    "phylum",
    "subphylum",
    "infraphylum",
    "microphylum",
    "superdivision",
    "division",
    "subdivision",
    "infradivision",
    "superclass",
    "class",
    "subclass",
    "infraclass",
    "superlegion",
    "legion",
    "sublegion",
    "infralegion",
    "supercohort",
    "cohort",
    "subcohort",
    "infracohort",
    "magnorder",
    "superorder",
    "order",
    "suborder",
    "infraorder",
    "superfamily",
    "family",
    "subfamily",
    "supertribe",
    "tribe",
    "subtribe",
    "infratribe",
    "genus",
    "subgenus",
    "superspecies",
    "species",
    "subspecies",
    "variety",
    "varietas",
    "subvariety",
    "form",
    "subform",
    "cultivar",
    "strain",
    "section",
    "subsection",
    "unknown",
    "other",
]

# Ranks whose inner-node labels are shown.
VISIBLE_RANKS = ["genus", "subgenus", "subfamily", "family"]

# Lineage fragment and the group it stands for, first match wins.
REALM_GROUPS = [
    ("pararnavirae", "RT viruses"),
    ("negarnaviricota", "–ssRNA"),
    ("duplodnaviria", "dsDNA (tailed)"),
    ("varidnaviria", "dsDNA (non-tailed)"),
    ("monodnaviria", "ssDNA"),
    ("floreoviria", "ssDNA"),
    ("singelaviria", "ssDNA"),
    ("ribozyviria", "deltavirus-like"),
    ("riboviria", "+ssRNA / dsRNA"),
]


def rank_depth(rank: Column) -> Column:
    low = F.lower(F.coalesce(rank, F.lit("")))
    depth = F.lit(0)
    for name, value in RANK_DEPTH.items():
        depth = F.when(low == name, value).otherwise(depth)
    return depth


def lineage_reaches(lineage: Column, min_rank: str | None) -> Column:
    """True when some entry is at least as specific as `min_rank`; unknown ranks ask for nothing."""
    depth = RANK_DEPTH.get((min_rank or "none").lower(), 0)
    if depth == 0:
        return F.lit(True)
    deep = [name for name, value in RANK_DEPTH.items() if value >= depth]
    return F.coalesce(F.exists(lineage, lambda e: F.lower(e["rank"]).isin(deep)), F.lit(False))


def is_single_word_virus(name: Column) -> Column:
    return F.lower(name).endswith("virus") & ~F.contains(F.trim(name), F.lit(" "))


def suffix_rank(name: Column) -> Column:
    """Rank told by the ending of a taxon name, "" when it tells none."""
    low = F.lower(name)
    out = F.when(is_single_word_virus(name), "genus").otherwise("")
    for ending, rank in reversed(RANK_SUFFIXES):
        out = F.when(low.endswith(ending), rank).otherwise(out)
    return out


def schema_rank(rank: Column) -> Column:
    return F.when(rank.isin(SCHEMA_RANKS), rank).otherwise("other")


def visible_label(name: Column, rank: Column, is_leaf: Column) -> Column:
    shown = is_leaf | F.coalesce(rank.isin(VISIBLE_RANKS), F.lit(False))
    return F.when(shown, F.coalesce(name, F.lit(""))).otherwise("")


def name_at_rank(lineage: Column, rank: str) -> Column:
    """Name of the last entry with this rank, NULL when there is none."""
    hits = F.filter(lineage, lambda e: F.lower(e["rank"]) == rank)
    return F.nullif(F.try_element_at(hits, F.lit(-1))["name"], F.lit(""))


def genus_proxy(lineage: Column, mode: str) -> Column:
    """Stand-in genus when the lineage has none: modes none, suffix, deepest."""
    if mode == "none":
        return F.lit(None).cast("string")
    by_suffix = F.get(F.filter(lineage, lambda e: is_single_word_virus(e["name"])), F.lit(0))["name"]
    if mode == "suffix":
        return by_suffix
    above = F.filter(
        lineage,
        lambda e: (F.length(e["name"]) > 0) & ~F.lower(F.coalesce(e["rank"], F.lit(""))).isin(SPECIES_OR_BELOW),
    )
    return F.coalesce(by_suffix, F.try_element_at(above, F.lit(-1))["name"])


def genus_of(lineage: Column, mode: str = "none") -> Column:
    return F.coalesce(name_at_rank(lineage, "genus"), genus_proxy(lineage, mode))


def realm_group(lineage_text: Column) -> Column:
    low = F.lower(F.coalesce(lineage_text, F.lit("")))
    out = F.lit("other")
    for fragment, label in reversed(REALM_GROUPS):
        out = F.when(F.contains(low, F.lit(fragment)), label).otherwise(out)
    return out


def common_prefix(first: Column, last: Column) -> Column:
    """Longest common prefix of two arrays.

    Applied to the smallest and the largest array of a set it gives the prefix
    shared by the whole set, since arrays compare element by element.
    """
    size = F.least(F.size(first), F.size(last))
    pairs = F.zip_with(F.slice(first, 1, size), F.slice(last, 1, size), lambda a, b: a.eqNullSafe(b))
    break_at = F.array_position(pairs, F.lit(False))
    return F.slice(first, F.lit(1), F.when(break_at > 0, (break_at - 1).cast("int")).otherwise(size))

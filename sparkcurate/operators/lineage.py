"""Lineages from a parent table, common ancestors and taxon groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ids import named_species
from ..functions.taxa import common_prefix, genus_of, name_at_rank, suffix_rank
from ..session import cut_lineage
from .scale import as_list


def resolve_lineages(taxa: DataFrame) -> DataFrame:
    """taxid, lineage: array of (taxid, name, rank) from the root to the taxon itself.

    taxa: taxid, parent_taxid, name, rank. Every round joins each taxon to the
    ancestor it has reached and doubles the known stretch, so depth d takes
    log2(d) rounds, however deep it is. What is still open after log2(number of taxa)
    rounds hangs on a cycle and comes out NULL.
    """
    entry = F.struct("taxid", "name", "rank")
    known_parent = F.when(F.col("parent_taxid") != F.col("taxid"), F.col("parent_taxid"))
    parents = taxa.select(F.col("taxid").alias("__p"))
    linked = taxa.join(parents, F.col("parent_taxid") == F.col("__p"), "left")
    state = cut_lineage(
        linked.select("taxid", F.array(entry).alias("lineage"), F.when(F.col("__p").isNotNull(), known_parent).alias("up"))
    )
    for _ in range(state.count().bit_length() + 1):
        if state.filter(F.col("up").isNotNull()).isEmpty():
            break
        above = state.select(F.col("taxid").alias("up"), F.col("lineage").alias("__above"), F.col("up").alias("__next"))
        state = cut_lineage(
            state.join(above, "up", "left").select(
                "taxid",
                F.when(F.col("__above").isNotNull(), F.concat("__above", "lineage")).otherwise(F.col("lineage")).alias("lineage"),
                F.col("__next").alias("up"),
            )
        )
    return state.select("taxid", F.when(F.col("up").isNull(), F.col("lineage")).alias("lineage"))


def ids_in(lineage: Column) -> Column:
    return F.transform(lineage, lambda e: e["taxid"])


def names_in(lineage: Column) -> Column:
    return F.transform(lineage, lambda e: e["name"])


def taxid_of(taxa: DataFrame, names: DataFrame) -> DataFrame:
    """Lowest taxid carrying each exact name; NULL when there is none."""
    found = taxa.groupBy("name").agg(F.min("taxid").alias("taxid"))
    return names.join(found, "name", "left")


def descendants_at_rank(lineages: DataFrame, roots: DataFrame, rank: str = "species", named_only: bool = True) -> DataFrame:
    """root, taxid, name of all taxa of a rank below each root (root, root_name).

    Every taxon lists its own ancestors, so the join is on equal ids.
    """
    tip = F.element_at("lineage", -1)
    at_rank = lineages.filter(tip["rank"] == rank).select(
        "taxid", tip["name"].alias("name"), F.explode(ids_in(F.col("lineage"))).alias("root")
    )
    found = at_rank.join(roots, "root")
    if named_only:
        found = found.filter(named_species(F.col("name"), F.col("root_name")))
    return found.select("root", "taxid", "name")


def prefer_resolved(records: DataFrame, lineages: DataFrame, taxon: str = "taxon_id", own: str = "lineage") -> DataFrame:
    """Resolved lineage names replace the record's own where the taxon is known."""
    ranked = lineages.select(F.col("taxid").alias(taxon), F.col("lineage").alias("lineage_ranked"))
    joined = records.join(ranked, taxon, "left")
    return joined.withColumn(own, F.coalesce(names_in(F.col("lineage_ranked")), F.col(own)))


def common_lineage(df: DataFrame, keys: str | Sequence[str], lineage: str = "lineage") -> DataFrame:
    """Longest lineage prefix shared by the rows of a group.

    The prefix of the smallest and the largest array; both come from partial
    aggregation, so no group is gathered.
    """
    ends = df.groupBy(*as_list(keys)).agg(
        F.min(lineage).alias("__a"), F.max(lineage).alias("__z"), F.count(F.lit(1)).alias("n")
    )
    return ends.select(*as_list(keys), "n", common_prefix(F.col("__a"), F.col("__z")).alias("common"))


def taxon_ranks(df: DataFrame, ordinal: str, lineage: str = "lineage_ranked") -> DataFrame:
    """name, rank: the first informative rank seen, else the one its ending tells."""
    entries = df.select(ordinal, F.posexplode(lineage).alias("__pos", "e")).select(
        ordinal, "__pos", F.col("e.name").alias("name"), F.col("e.rank").alias("rank")
    )
    told = F.when((F.length("rank") > 0) & (F.col("rank") != "no rank"), F.struct(ordinal, "__pos", "rank"))
    return (
        entries.filter(F.length("name") > 0)
        .groupBy("name")
        .agg(F.min(told).alias("first"))
        .select("name", F.coalesce(F.col("first.rank"), suffix_rank(F.col("name"))).alias("rank"))
    )


def taxon_groups(leaves: DataFrame, tree: str = "tree_id", lineage: str = "lineage_ranked", mode: str = "none") -> DataFrame:
    """Genus index inside its subfamily group, per tree.

    Named subfamilies come first in name order, leaves without one share the last
    group. Columns: tree, subfamily, genus, group_index, genus_index, group_size,
    n_leaves. Leaves without a genus are left out.
    """
    named = leaves.select(
        tree, genus_of(F.col(lineage), mode).alias("genus"), name_at_rank(F.col(lineage), "subfamily").alias("subfamily")
    ).filter(F.col("genus").isNotNull())
    genera = named.groupBy(tree, "subfamily", "genus").agg(F.count(F.lit(1)).alias("n_leaves"))
    groups = W.partitionBy(tree).orderBy(F.col("subfamily").isNull(), "subfamily")
    inside = W.partitionBy(tree, "subfamily")
    return genera.withColumns(
        {
            "group_index": F.dense_rank().over(groups) - 1,
            "genus_index": F.row_number().over(inside.orderBy("genus")) - 1,
            "group_size": F.count(F.lit(1)).over(inside),
        }
    )


def taxon_counts(leaves: DataFrame, tree: str = "tree_id", lineage: str = "lineage_ranked", mode: str = "none") -> DataFrame:
    """Distinct genera and named subfamilies among leaves that have a genus."""
    rows = leaves.select(
        tree, genus_of(F.col(lineage), mode).alias("genus"), name_at_rank(F.col(lineage), "subfamily").alias("subfamily")
    )
    with_genus = F.col("genus").isNotNull()
    return rows.groupBy(tree).agg(
        F.count_distinct("genus").alias("n_genera"),
        F.count_distinct(F.when(with_genus, F.col("subfamily"))).alias("n_subfamilies"),
    )

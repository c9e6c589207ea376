"""Operators on node tables of many trees.

nodes: tree_id, node_id, parent_id, preorder, is_leaf, name, branch_length, confidence.
Aggregates over subtrees and along root paths use pointer doubling: in round k each
node knows its ancestor 2^k steps up, so a tree of depth d takes log2(d) rounds of
one row per node, whatever its shape. No (node, leaf) table is built for them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.taxa import common_prefix, lineage_reaches, suffix_rank
from ..session import cut_lineage
from .scale import exact_median, first_k

KEY = ["tree_id", "node_id"]


def open_rounds(state: Callable[[], DataFrame]) -> Iterator[int]:
    """Rounds of pointer doubling while some row has an ancestor left; a tree with n nodes needs at most log2(n)."""
    limit = state().count().bit_length() + 1
    for done in range(limit + 1):
        if state().filter(F.col("up").isNotNull()).isEmpty():
            return
        if done == limit:
            raise ValueError("the node table has a cycle")
        yield done


def subtree_aggregate(nodes: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Aggregate columns of each node's whole subtree, the node included.

    values: column -> sum, min or max. NULLs are ignored.
    """
    fold = {"sum": F.sum, "min": F.min, "max": F.max}
    state = cut_lineage(nodes.select(*KEY, F.col("parent_id").alias("up"), *values))
    for _ in open_rounds(lambda: state):
        above = state.select("tree_id", F.col("node_id").alias("up"), F.col("up").alias("__next"))
        own = state.join(above, ["tree_id", "up"], "left").select(*KEY, F.col("__next").alias("up"), *values)
        none = F.lit(None).cast(state.schema["up"].dataType)
        lifted = state.filter(F.col("up").isNotNull()).select("tree_id", F.col("up").alias("node_id"), none.alias("up"), *values)
        # own rows bring the ancestor twice as far along, so the sums and the next round need one aggregation
        merged = own.unionByName(lifted).groupBy(*KEY)
        state = cut_lineage(merged.agg(F.max("up").alias("up"), *[fold[how](c).alias(c) for c, how in values.items()]))
    return state.drop("up")


def _double(state: DataFrame) -> DataFrame:
    """tree_id, node_id, up: the ancestor twice as far as the one known."""
    here = state.select(*KEY, "up")
    above = here.select("tree_id", F.col("node_id").alias("up"), F.col("up").alias("__next"))
    return here.join(above, ["tree_id", "up"], "left").select(*KEY, F.col("__next").alias("up"))


def path_sum(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Sum of columns over each node and all its ancestors."""
    state = cut_lineage(nodes.select(*KEY, F.col("parent_id").alias("up"), *values))
    for _ in open_rounds(lambda: state):
        above = state.select(
            "tree_id", F.col("node_id").alias("up"), F.col("up").alias("__next"), *[F.col(v).alias(f"__{v}") for v in values]
        )
        joined = state.join(above, ["tree_id", "up"], "left")
        state = cut_lineage(
            joined.select(
                *KEY, F.col("__next").alias("up"), *[(F.col(v) + F.coalesce(F.col(f"__{v}"), F.lit(0))).alias(v) for v in values]
            )
        )
    return state.drop("up")


def path_ends(nodes: DataFrame, low: str, high: str) -> DataFrame:
    """Smallest `low` and largest `high` over each node and all its ancestors; NULLs are ignored."""
    state = cut_lineage(nodes.select(*KEY, F.col("parent_id").alias("up"), low, high))
    for _ in open_rounds(lambda: state):
        above = state.select("tree_id", F.col("node_id").alias("up"), F.col("up").alias("__next"), F.col(low).alias("__l"), F.col(high).alias("__h"))
        joined = state.join(above, ["tree_id", "up"], "left")
        smaller = F.when(F.col("__l").isNull() | (F.col(low) <= F.col("__l")), F.col(low)).otherwise(F.col("__l"))
        larger = F.when(F.col("__h").isNull() | (F.col(high) >= F.col("__h")), F.col(high)).otherwise(F.col("__h"))
        state = cut_lineage(
            joined.select(*KEY, F.col("__next").alias("up"), F.coalesce(smaller, "__l").alias(low), F.coalesce(larger, "__h").alias(high))
        )
    return state.drop("up")


def leaf_closure(nodes: DataFrame) -> DataFrame:
    """tree_id, node_id, leaf_id for every node and each leaf below it (or itself)."""
    reach = cut_lineage(
        nodes.filter("is_leaf").select("tree_id", F.col("node_id").alias("leaf_id"), "node_id")
    )
    jumps = cut_lineage(nodes.select(*KEY, F.col("parent_id").alias("up")))
    for _ in open_rounds(lambda: jumps):
        lifted = reach.join(jumps.filter(F.col("up").isNotNull()), KEY).select("tree_id", "leaf_id", F.col("up").alias("node_id"))
        # pairs at distances 0 .. 2^k-1 and their lifts by 2^k never coincide
        reach = cut_lineage(reach.unionByName(lifted))
        jumps = cut_lineage(_double(jumps))
    return reach.select(*KEY, "leaf_id")


# --------------------------------------------------------------------------
# labels


def clade_lineages(nodes: DataFrame, leaf_lineages: DataFrame) -> DataFrame:
    """Per node: n_leaves, n_voters and the lineage its voting leaves share.

    leaf_lineages: tree_id, name, lineage (array of names; rows without one do not vote).
    """
    votes = leaf_lineages.filter(F.size("lineage") > 0).select("tree_id", "name", F.col("lineage").alias("low"))
    seeded = nodes.select("tree_id", "node_id", "parent_id", "is_leaf", F.when(F.col("is_leaf"), F.col("name")).alias("name"))
    seeded = seeded.join(votes, ["tree_id", "name"], "left").select(
        *KEY, "parent_id", "low", F.col("low").alias("high"),
        F.col("is_leaf").cast("bigint").alias("n_leaves"), F.col("low").isNotNull().cast("bigint").alias("n_voters"),
    )
    ends = subtree_aggregate(seeded, {"n_leaves": "sum", "n_voters": "sum", "low": "min", "high": "max"})
    return ends.select(*KEY, "n_leaves", "n_voters", common_prefix(F.col("low"), F.col("high")).alias("common"), "low", "high")


def voting_lineages(leaves: DataFrame, min_rank: str = "none") -> DataFrame:
    """Leaves whose ranked lineage is deep enough to vote."""
    return leaves.filter(lineage_reaches(F.col("lineage_ranked"), min_rank))


def label_nodes(nodes: DataFrame, leaf_lineages: DataFrame, ranks: DataFrame | None = None) -> DataFrame:
    """Inner nodes with label and rank; NULL where fewer than half of the leaves vote.

    `ranks` (name, rank) gives known ranks; otherwise the name's ending tells.
    """
    clades = clade_lineages(nodes, leaf_lineages)
    inner = nodes.filter(~F.col("is_leaf")).select(*KEY, "parent_id", "preorder", "confidence")
    enough = (F.col("n_voters") > 0) & (F.col("n_voters") * 2 >= F.col("n_leaves"))
    label = F.when(enough, F.try_element_at("common", F.lit(-1)))
    labelled = inner.join(clades, KEY).select(*inner.columns, "n_leaves", "n_voters", label.alias("label"))
    if ranks is None:
        return labelled.withColumn("rank", suffix_rank(F.col("label")))
    known = ranks.select(F.col("name").alias("label"), F.col("rank").alias("__rank"))
    return labelled.join(known, "label", "left").withColumn(
        "rank", F.coalesce(F.nullif("__rank", F.lit("")), suffix_rank(F.col("label")))
    ).select(*labelled.columns, "rank")


def crown_labels(labelled: DataFrame) -> DataFrame:
    """Keep each label of a tree only at its largest clade (lowest preorder on ties)."""
    named = labelled.filter(F.length("label") > 0)
    crown = first_k(named, ["tree_id", "label"], [F.desc("n_leaves"), F.col("preorder")], 1).select(*KEY, F.lit(True).alias("__crown"))
    joined = labelled.join(crown, KEY, "left")
    return joined.withColumn("label", F.when(F.col("__crown"), F.col("label"))).drop("__crown")


def normalise_support(nodes: DataFrame) -> DataFrame:
    """Support on the 0-100 scale as whole numbers; a tree with no value above 1 is scaled up."""
    top = nodes.groupBy("tree_id").agg(F.max("confidence").alias("__top"))
    scale = F.when(F.col("__top") <= 1.0, F.lit(100.0)).otherwise(F.lit(1.0))
    return nodes.join(top, "tree_id").withColumn("confidence", F.bround(F.col("confidence") * scale, 0)).drop("__top")


def same_species_pairs(nodes: DataFrame, leaf_species: DataFrame) -> DataFrame:
    """Nodes whose only children are two leaves of one species; their label says nothing new."""
    kids = nodes.filter(F.col("parent_id").isNotNull()).join(leaf_species, ["tree_id", "name"], "left")
    return (
        kids.groupBy("tree_id", F.col("parent_id").alias("node_id"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("is_leaf").alias("leaves"),
            F.count(F.nullif("species", F.lit(""))).alias("named"),
            (F.min("species") == F.max("species")).alias("same"),
        )
        .filter("n = 2 AND leaves AND named = 2 AND same")
        .select(*KEY)
    )


def shown_labels(labelled: DataFrame, nodes: DataFrame, leaf_species: DataFrame) -> DataFrame:
    pairs = same_species_pairs(nodes, leaf_species).withColumn("__pair", F.lit(True))
    joined = labelled.join(pairs, KEY, "left")
    return joined.withColumn("label", F.when(F.col("__pair").isNull(), F.col("label"))).drop("__pair")


def restore_names(nodes: DataFrame, id_map: DataFrame) -> DataFrame:
    """Leaves take their display name, or keep the id when it is not mapped; inner names go.

    Short ids are unique within a family only, so the tree or family takes part in the join where both know it.
    """
    group = [c for c in ("tree_id", "family") if c in nodes.columns and c in id_map.columns]
    names = id_map.select(*group, F.col("short_id").alias("name"), "display_name")
    joined = nodes.join(names, [*group, "name"], "left")
    shown = F.when(F.col("is_leaf"), F.coalesce("display_name", "name"))
    return joined.withColumn("name", shown).select(*nodes.columns)


# --------------------------------------------------------------------------
# branch lengths


def branch_stats(nodes: DataFrame) -> DataFrame:
    """Median and median absolute deviation of positive leaf branches; zeros below three of them."""
    leaves = nodes.filter(F.col("is_leaf") & (F.col("branch_length") > 0) & (F.length("name") > 0))
    med = exact_median(leaves, "tree_id", "branch_length", integral=False)
    spread = leaves.join(med, "tree_id").withColumn("__dev", F.abs(F.col("branch_length") - F.col("median")))
    mad = exact_median(spread, "tree_id", "__dev", "mad", integral=False).drop("n")
    enough = F.col("n") >= 3
    stats = med.join(mad, "tree_id").select(
        "tree_id", F.when(enough, F.col("median")).otherwise(0.0).alias("median"), F.when(enough, F.col("mad")).otherwise(0.0).alias("mad")
    )
    return nodes.select("tree_id").distinct().join(stats, "tree_id", "left").fillna(0.0, ["median", "mad"])


def branch_outliers(nodes: DataFrame, factor: float = 20.0) -> DataFrame:
    """Leaves longer than median + factor * MAD, with their distance in MADs."""
    joined = nodes.filter(F.col("is_leaf") & (F.length("name") > 0)).join(branch_stats(nodes), "tree_id")
    limit = F.col("median") + F.lit(factor) * F.col("mad")
    usable = (F.col("median") != 0) & (F.col("mad") != 0)
    return joined.filter(usable & (F.col("branch_length") > limit)).withColumn(
        "mads_above", (F.col("branch_length") - F.col("median")) / F.col("mad")
    )


def guarded_outliers(nodes: DataFrame, protected: DataFrame, factor: float = 20.0, min_seqs: int = 40) -> DataFrame:
    """Outliers with the action taken: removed, protected, or kept because the tree would get too small.

    protected: tree_id, name.
    """
    flagged = branch_outliers(nodes, factor).join(protected.withColumn("__p", F.lit(True)), ["tree_id", "name"], "left")
    sizes = nodes.filter("is_leaf").groupBy("tree_id").agg(F.count(F.lit(1)).alias("n_leaves"))
    losses = flagged.groupBy("tree_id").agg(F.count_if(F.col("__p").isNull()).alias("n_out"))
    joined = flagged.join(sizes, "tree_id").join(losses, "tree_id")
    small = (F.col("n_leaves") <= min_seqs) | (F.col("n_leaves") - F.col("n_out") < min_seqs)
    action = F.when(F.col("__p"), "protected").when(small, "kept").otherwise("removed")
    return joined.select("tree_id", "name", "branch_length", "mads_above", action.alias("action"))


# --------------------------------------------------------------------------
# root placement


def rooting_scores(nodes: DataFrame, leaf_lineages: DataFrame) -> DataFrame:
    """Score of placing the root on each branch: tree_id, node_id, score, place (1 = best).

    The score is the depth of each inner clade's common lineage, weighted by its
    leaves, over clades where at least half of the leaves vote. A branch is named by
    the node below it. Re-rooting turns only the clades on the path to the old root
    round, so each directed branch is weighed once and the path is summed up.
    """
    def weight(n: Column, v: Column, low: Column, high: Column) -> tuple[Column, Column]:
        counts = (v > 0) & (v * 2 >= n)
        return F.when(counts, F.size(common_prefix(low, high)) * n).otherwise(0), F.when(counts, n).otherwise(0)

    down = clade_lineages(nodes, leaf_lineages)
    d_num, d_den = weight(F.col("n_leaves"), F.col("n_voters"), F.col("low"), F.col("high"))
    inner = ~F.col("is_leaf")
    base = cut_lineage(
        nodes.select(*KEY, "parent_id", "is_leaf", "branch_length").join(down, KEY).select(
            *KEY, "parent_id", "branch_length", F.col("n_leaves").alias("dn"), F.col("n_voters").alias("dv"), "low", "high",
            F.when(inner, d_num).otherwise(0).alias("d_num"), F.when(inner, d_den).otherwise(0).alias("d_den"),
        )
    )
    # children of a node: the smallest and the largest array, and the next ones, serve every "all but one"
    parent = ["tree_id", "parent_id"]
    kids = base.filter(F.col("parent_id").isNotNull())
    first = kids.groupBy(*parent).agg(
        F.count(F.lit(1)).alias("n_kids"),
        F.min(F.when(F.col("low").isNotNull(), F.struct("low", "node_id"))).alias("lows"),
        F.max(F.when(F.col("high").isNotNull(), F.struct("high", "node_id"))).alias("highs"),
    )
    among = kids.join(first, parent)
    lowest, highest = (F.coalesce(F.col("node_id") == F.col(f"{c}.node_id"), F.lit(False)) for c in ("lows", "highs"))
    second = among.groupBy(*parent).agg(F.min(F.when(~lowest, F.col("low"))).alias("low2"), F.max(F.when(~highest, F.col("high"))).alias("high2"))
    carried = [*KEY, "parent_id", "branch_length", "dn", "dv", "d_num", "d_den"]
    none = F.lit(None).cast(base.schema["low"].dataType)
    roots = base.filter(F.col("parent_id").isNull())
    sib = cut_lineage(
        among.join(second, parent).select(
            *carried, "n_kids",
            F.when(lowest, F.col("low2")).otherwise(F.col("lows.low")).alias("sib_low"),
            F.when(highest, F.col("high2")).otherwise(F.col("highs.high")).alias("sib_high"),
        ).unionByName(roots.select(*carried, F.lit(None).cast("bigint").alias("n_kids"), none.alias("sib_low"), none.alias("sib_high")))
    )
    up = path_ends(sib.select(*KEY, "parent_id", "sib_low", "sib_high"), "sib_low", "sib_high")
    a_num, a_den = weight(F.col("dn"), F.col("dv"), F.col("low"), F.col("high"))
    whole = roots.select(
        "tree_id", F.col("node_id").alias("__root"), F.col("dn").alias("all_n"), F.col("dv").alias("all_v"), a_num.alias("a_num"), a_den.alias("a_den"))
    edges = sib.drop("sib_low", "sib_high").join(up, KEY).join(whole, "tree_id")
    u_num, u_den = weight(F.col("all_n") - F.col("dn"), F.col("all_v") - F.col("dv"), F.col("sib_low"), F.col("sib_high"))
    weighed = cut_lineage(
        edges.select(
            *KEY, "parent_id", "branch_length", "n_kids", "__root", "d_num", "d_den",
            u_num.alias("u_num"), u_den.alias("u_den"), "a_num", "a_den",
        )
    )
    # below an old root with two branches the turned root clade vanishes
    is_root = F.col("parent_id").isNull()
    vanishes = (F.col("parent_id") == F.col("__root")) & (F.col("n_kids") == 2)
    gain = lambda c: F.when(is_root | vanishes, 0).otherwise(F.col(f"u_{c}"))
    steps = weighed.select(
        *KEY, "parent_id", *[(gain(c) - F.col(f"d_{c}")).cast("bigint").alias(f"s_{c}") for c in ("num", "den")]
    )
    summed = path_sum(steps, ["s_num", "s_den"])
    totals = weighed.groupBy("tree_id").agg(F.sum("d_num").alias("t_num"), F.sum("d_den").alias("t_den"))
    scored = weighed.filter(~is_root).join(summed, KEY).join(totals, "tree_id")
    num = F.col("t_num") + F.col("s_num") + F.col("a_num")
    den = F.col("t_den") + F.col("s_den") + F.col("a_den")
    score = F.when(den > 0, num / den).otherwise(0.0)
    return scored.select(*KEY, F.coalesce("branch_length", F.lit(0.0)).alias("branch_length"), score.alias("score"))


def best_roots(scores: DataFrame, k: int = 1) -> DataFrame:
    """The k best branches of each tree; ties go to the shorter branch, then the lower node."""
    return first_k(scores, "tree_id", [F.desc("score"), F.col("branch_length"), F.col("node_id")], k, "place")

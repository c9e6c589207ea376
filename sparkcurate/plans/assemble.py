"""Genome selection: concatenate, absorb, cluster and sample whole genomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import is_protected_id
from ..operators.cluster import ClusterRules, absorb, adaptive_cluster, signatures
from ..operators.concat import raw_concat
from ..operators.sample import quota_sample, selection_stats
from ..session import cut_lineage


def select_genomes(
    genome_markers: DataFrame,
    target: int,
    max_reps: int,
    rules: ClusterRules = ClusterRules(),
    seed: int = 42,
    mode: str = "strict",
) -> tuple[DataFrame, DataFrame]:
    """genome_markers: family, species, genome_id, marker_order, seq.

    Returns (selected, stats): selected has family, species, genome_id, protected;
    stats the counters per family. Genomes compare by their unaligned concatenation.
    """
    group = ["family", "species"]
    genomes = raw_concat(genome_markers).withColumn("protected", is_protected_id(F.col("genome_id")))
    sigs = cut_lineage(signatures(genomes, group, "genome_id", "seq", rules, ["protected"]))
    kinds = sigs.select(*group, F.col("id").alias("genome_id"), "protected")
    bare = sigs.drop("protected")
    absorbed = cut_lineage(absorb(genomes, group, "genome_id", rules=rules, sigs=bare))
    kept = bare.join(absorbed.select(*group, F.col("genome_id").alias("id")), [*group, "id"], "left_anti")
    reps, thresholds = adaptive_cluster(genomes, group, max_reps, "genome_id", rules=rules, sigs=kept)
    reps = cut_lineage(reps.drop("max_reps").join(kinds, [*group, "genome_id"]))
    selected = quota_sample(reps, "family", "species", target, "genome_id", seed=seed, mode=mode)
    lost = absorbed.groupBy(*group).agg(F.count(F.lit(1)).alias("n_absorbed"))
    used = thresholds.join(lost, group, "left").fillna(0, ["n_absorbed"])
    return selected, selection_stats(selected, reps, used, "family", "species")

"""Layered settings as a long table, and checks of marker specifications."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layers from lowest to highest priority.
LAYERS = {"defaults": 0, "global": 1, "preset": 2, "family": 3}

# Default settings.
DEFAULTS: dict[str, Any] = {
    "download.max_per_species": 300,
    "sequence.type": "nucleotide",
    "sequence.region": "whole_genome",
    "quality.max_ambiguous": 0.01,
    "clustering.threshold_min": 0.70,
    "clustering.threshold_max": 0.99,
    "clustering.max_reps_500": 20,
    "clustering.max_reps_100": 5,
    "targets.max_500": 500,
    "targets.max_100": 100,
    "concatenation.min_fraction": 0.7,
    "refseq_absorption.enabled": True,
    "refseq_absorption.threshold": 0.99,
    "length_outlier.enabled": True,
    "length_outlier.hi_mult": 3.0,
    "length_outlier.lo_mult": 0.333,
    "outlier_removal.enabled": True,
    "outlier_removal.factor": 20.0,
    "outlier_removal.max_iterations": 3,
    "outlier_removal.min_seqs": 40,
    "coloring.genus_inference": "none",
    "taxonomy.lca_min_rank": "none",
}


def flatten(nested: Mapping[str, Any], prefix: str = "") -> dict[str, str | None]:
    """Dotted keys; lists and scalars are leaves, so lists are replaced whole."""
    import json

    out: dict[str, str | None] = {}
    for key, value in nested.items():
        path = f"{prefix}{key}"
        if isinstance(value, Mapping):
            out.update(flatten(value, f"{path}."))
        else:
            out[path] = None if value is None else value if isinstance(value, str) else json.dumps(value)
    return out


def layer_rows(spark: SparkSession, layer: str, families: DataFrame, nested: Mapping[str, Any]) -> DataFrame:
    """The same settings for every family of a list."""
    pairs = [F.struct(F.lit(k).alias("key"), F.lit(v).cast("string").alias("value")) for k, v in flatten(nested).items()]
    return families.select("family", F.explode(F.array(*pairs)).alias("s")).select(
        "family", F.lit(LAYERS[layer]).alias("layer"), "s.key", "s.value"
    )


def preset_rows(families: DataFrame, segments: DataFrame, dna: DataFrame, markers: DataFrame) -> DataFrame:
    """Type presets: concatenation beats the single region, a segment is set on its own."""
    concat = markers.select("family").distinct().withColumn("concat", F.lit(True))
    known = (
        families.select("family")
        .join(segments, "family", "left")
        .join(dna, "family", "left")
        .join(concat, "family", "left")
    )
    region = F.when(F.col("concat"), "concatenated").otherwise(F.col("region"))
    # a whole-genome preset leaves the molecule as it is
    kind = F.when(F.col("concat"), "protein").when(F.col("region") != "whole_genome", F.col("molecule"))
    entries = F.array(
        F.struct(F.lit("sequence.segment").alias("key"), F.col("segment").alias("value")),
        F.struct(F.lit("sequence.region").alias("key"), region.alias("value")),
        F.struct(F.lit("sequence.type").alias("key"), kind.alias("value")),
    )
    return known.select("family", F.lit(LAYERS["preset"]).alias("layer"), F.explode(entries).alias("s")).select(
        "family", "layer", "s.key", "s.value"
    ).filter(F.col("value").isNotNull())


def resolve(settings: DataFrame) -> DataFrame:
    """family, key, value of the highest layer; a segment set lower down is not replaced by a preset."""
    own_segment = (F.col("key") == "sequence.segment") & (F.length("value") > 0)
    weak = (F.col("key") == "sequence.segment") & (F.col("layer") == LAYERS["preset"])
    rank = F.when(weak, F.lit(0.5)).otherwise(F.col("layer").cast("double"))
    return settings.filter(~((F.col("key") == "sequence.segment") & (F.col("layer") < 2) & ~own_segment)).groupBy(
        "family", "key"
    ).agg(F.max_by("value", rank).alias("value"))


def marker_violations(markers: DataFrame, wanted: DataFrame) -> DataFrame:
    """family, marker_order, problem. `wanted`: family, min_fraction of concatenated families."""
    rows = wanted.join(markers, "family", "left")
    missing = F.col("marker_order").isNull()
    problem = (
        F.when(missing, "no markers")
        .when(~(F.length(F.trim(F.coalesce("name", F.lit("")))) > 0), "marker without a name")
        .when(F.col("aliases").isNull() | F.exists("aliases", lambda a: a.isNull()), "aliases are not a list of strings")
        .when(F.col("len_min").isNull() != F.col("len_max").isNull(), "length range is incomplete")
        .when(F.col("len_min") >= F.col("len_max"), "length range is not increasing")
    )
    spec = rows.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select("family", "marker_order", "problem")
    bad = F.coalesce(~((F.col("min_fraction") > 0) & (F.col("min_fraction") <= 1)), F.lit(True))
    share = wanted.filter(bad).select("family", F.lit(None).cast("int").alias("marker_order"), F.lit("min_fraction is not in (0, 1]").alias("problem"))
    return spec.unionByName(share)

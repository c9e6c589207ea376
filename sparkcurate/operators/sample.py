"""Capped and proportional sampling with protected rows first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .scale import as_list, attach_groups, first_k


def protected_first_cap(
    df: DataFrame,
    group: str | Sequence[str],
    cap: int,
    protected: str = "protected",
    ordinal: str = "ordinal",
) -> DataFrame:
    """All protected rows, topped up to `cap` with the others.

    The others come from the first `cap` rows of the group in input order, so a
    protected row among those uses up a place in the scan.
    """
    group = as_list(group)
    n_protected = df.filter(protected).groupBy(*group).agg(F.count(F.lit(1)).alias("__prot"))
    window = first_k(df, group, [F.col(ordinal)], cap, spread=F.col(ordinal))
    others = window.filter(~F.col(protected))
    others = first_k(others, group, [F.col(ordinal)], cap, "__rank", F.col(ordinal)).join(n_protected, group, "left")
    room = F.greatest(F.lit(0), F.lit(cap) - F.coalesce(F.col("__prot"), F.lit(0)))
    others = others.filter(F.col("__rank") <= room).drop("__rank", "__prot")
    return df.filter(protected).unionByName(others.select(*df.columns))


def seeded_key(seed: int, identifier: Column) -> Column:
    """Reproducible pseudo-random order of rows."""
    return F.md5(F.concat(F.lit(f"{seed}|"), identifier.cast("string")))


def species_counts(reps: DataFrame, family: Sequence[str], species: str) -> DataFrame:
    return reps.groupBy(*family, species).agg(F.count(F.lit(1)).alias("n_reps"))


def top_species(counts: DataFrame, family: Sequence[str], species: str, target: int) -> DataFrame:
    """The `target` species with most rows, ties by name."""
    return first_k(counts, family, [F.desc("n_reps"), F.col(species)], target, "species_rank", F.col(species))


def fraction_order(shares: DataFrame, family: Sequence[str], species: str, raw: str, name: str) -> DataFrame:
    """Rank of each species by the fractional part of its share, largest first, ties by name."""
    fraction = F.col(raw) - F.floor(raw)
    return shares.withColumn(name, F.row_number().over(W.partitionBy(*family).orderBy(F.desc(fraction), F.col(species))))


def quotas(
    counts: DataFrame,
    family: str | Sequence[str],
    species: str,
    target: int,
    mode: str = "strict",
) -> DataFrame:
    """Places per species: columns family, species, n_reps, quota.

    Everything when the total fits; one place for each of the largest species when
    there are more species than places; otherwise shares rounded half-even, at
    least one, corrected in order of their fractional part. "compat" corrects in a
    single pass and may stay above the target; "strict" repeats the pass.

    Only families with at most `target` species are ranked, so no window holds more
    than `target` rows. How many passes remove a place follows in closed form from
    the histogram of the rounded shares.
    """
    family = as_list(family)
    present = counts.filter(F.col("n_reps") > 0)
    totals = present.groupBy(*family).agg(F.sum("n_reps").alias("__total"), F.count(F.lit(1)).alias("__species"))
    sized = attach_groups(present, totals, family, "inner")
    whole = sized.filter(F.col("__total") <= target).withColumn("quota", F.col("n_reps"))

    crowded = sized.filter((F.col("__total") > target) & (F.col("__species") > target))
    first = top_species(crowded, family, species, target).select(*family, species, F.lit(1).alias("__one"))
    ones = crowded.join(first, [*family, species], "left").withColumn("quota", F.coalesce("__one", F.lit(0)).cast("bigint"))

    shared = sized.filter((F.col("__total") > target) & (F.col("__species") <= target))
    shared = shared.withColumn("__share", F.col("n_reps") / F.col("__total") * F.lit(target))
    shared = fraction_order(shared, family, species, "__share", "__order")
    shared = cut_lineage(shared.withColumn("__raw", F.greatest(F.lit(1), F.bround("__share", 0).cast("bigint"))))
    levels = attach_groups(shared, _removal(shared, family, target, mode), family)
    # a species gives one place in each whole pass, and the first ones in order one more
    more = F.col("__raw") - 1 > F.col("__passes")
    turn = F.sum(more.cast("bigint")).over(W.partitionBy(*family).orderBy("__order").rowsBetween(W.unboundedPreceding, 0))
    levels = levels.withColumn("__turn", turn)
    given = F.least(F.col("__raw") - 1, F.col("__passes")) + (more & (F.col("__turn") <= F.col("__rest"))).cast("bigint")
    gains = (F.col("__order") <= F.col("__diff")).cast("bigint")
    corrected = levels.withColumn("quota", F.col("__raw") + F.when(F.col("__diff") < 0, -given).otherwise(gains))

    named = [df.select(*family, species, "n_reps", F.col("quota").cast("bigint").alias("quota")) for df in (whole, ones, corrected)]
    return named[0].unionByName(named[1]).unionByName(named[2])


def _removal(shared: DataFrame, family: list[str], target: int, mode: str) -> DataFrame:
    """Per family: __diff (places missing, or negative: too many), __passes (whole passes) and __rest (places of the next).

    After p passes min(raw - 1, p) places of each species are gone. Between neighbouring values of raw - 1 that sum
    grows by the number of species above, so the last whole pass follows from the segment it falls into.
    """
    spare = (F.col("__raw") - 1).alias("__at")
    none = shared.select(*family, F.lit(0).cast("bigint").alias("__at"), F.lit(0).cast("bigint").alias("__n")).distinct()
    bars = shared.groupBy(*family, spare).agg(F.count(F.lit(1)).alias("__n")).unionByName(none)
    bars = bars.groupBy(*family, "__at").agg(F.sum("__n").alias("__n"))
    everything = W.partitionBy(*family)
    up_to = everything.orderBy("__at").rowsBetween(W.unboundedPreceding, 0)
    bars = bars.select(
        *family, "__at",
        F.sum(F.col("__n") * F.col("__at")).over(up_to).alias("__low"),
        (F.sum("__n").over(everything) - F.sum("__n").over(up_to)).alias("__above"),
        (F.sum(F.col("__n") * (F.col("__at") + 1)).over(everything) - target).alias("__excess"))
    gone = F.col("__low") + F.col("__at") * F.col("__above")
    reached = F.when(gone <= F.col("__excess"), F.struct("__at", gone.alias("__gone"), "__above"))
    found = bars.groupBy(*family).agg(F.max("__excess").alias("__excess"), F.max(reached).alias("__s"))
    left = F.col("__excess") - F.col("__s.__gone")
    whole = F.when(F.col("__s.__above") > 0, F.floor(left / F.col("__s.__above"))).otherwise(F.lit(0))
    found = found.withColumn("__whole", whole.cast("bigint")).select(
        *family, (-F.col("__excess")).alias("__diff"), (F.col("__s.__at") + F.col("__whole")).alias("__passes"),
        (left - F.col("__whole") * F.col("__s.__above")).alias("__rest"))
    if mode == "strict":
        return found
    once = F.col("__passes") >= 1
    return found.withColumn("__rest", F.when(once, 0).otherwise(F.col("__rest"))).withColumn("__passes", F.when(once, 1).otherwise(0))


def quota_sample(
    reps: DataFrame,
    family: str | Sequence[str],
    species: str,
    target: int,
    identifier: str = "accession",
    protected: str = "protected",
    seed: int = 42,
    mode: str = "strict",
) -> DataFrame:
    """At most `target` rows per family (strict mode), shared out over its species."""
    family = as_list(family)
    plan = quotas(species_counts(reps, family, species), family, species, target, mode)
    order = [F.desc(protected), seeded_key(seed, F.col(identifier)), F.col(identifier)]
    # no quota exceeds target + 1, so the rest of a large species leaves before the shuffle
    ranked = first_k(reps, [*family, species], order, target + 1, "__rank", F.col(identifier))
    return (
        ranked.join(plan.select(*family, species, "quota"), [*family, species])
        .filter(F.col("__rank") <= F.col("quota"))
        .drop("__rank", "quota")
    )


def selection_stats(selected: DataFrame, reps: DataFrame, thresholds: DataFrame, family: str | Sequence[str], species: str) -> DataFrame:
    """Absorbed rows, species and representatives, selected rows, threshold range at 4 decimals.

    `thresholds` has one row per species with threshold and n_absorbed.
    """
    family = as_list(family)
    rep_side = species_counts(reps, family, species).groupBy(*family).agg(
        F.count(F.lit(1)).alias("n_species_with_reps"), F.sum("n_reps").alias("n_total_reps")
    )
    picked = selected.groupBy(*family).agg(F.count(F.lit(1)).alias("n_selected"))
    used = thresholds.groupBy(*family).agg(
        F.sum("n_absorbed").alias("n_absorbed"),
        F.bround(F.min("threshold"), 4).alias("cluster_thresh_min"),
        F.bround(F.max("threshold"), 4).alias("cluster_thresh_max"),
    )
    return used.join(rep_side, family, "left").join(picked, family, "left").fillna(
        0, ["n_species_with_reps", "n_total_reps", "n_selected"]
    )

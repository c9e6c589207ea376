"""Quality filters whose thresholds follow each group's own distribution."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import ambiguity_codes, ambiguous_fraction, length_floor, mentions_any
from .scale import _rank_values, as_list, attach_groups, exact_median, keep_first, median_of, small_side

# Shares of the median tried in turn, and the default exclusion terms.
MEDIAN_SHARES = (0.5, 0.4, 0.3)
EXCLUDED_TERMS = (
    "synthetic construct", "metagenome", "MAG:", "uncultured",
    "unverified", "vector", "recombinant", "patent",
)


@dataclass(frozen=True)
class QualityRules:
    molecule: str = "nucleotide"
    min_length: int | None = None
    max_ambiguous: float = 0.01
    exclude: Sequence[str] = EXCLUDED_TERMS
    codes: str | None = None
    text_fields: Sequence[str] = field(default=("organism", "source", "description"))

    @property
    def floor(self) -> int:
        return length_floor(self.molecule)

    @property
    def ambiguity(self) -> str:
        return self.codes or ambiguity_codes(self.molecule)


def deduplicate(df: DataFrame, keys: Sequence[str], ordinal: str = "ordinal") -> DataFrame:
    """First row of every key in input order."""
    return keep_first(df, keys, [F.col(ordinal)])


def duplicate_counts(df: DataFrame, group: Sequence[str], accession: str) -> DataFrame:
    """Rows removed by de-duplication per group."""
    per_key = df.groupBy(*group, accession).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.groupBy(*group).agg(
        F.sum("__n").alias("n_rows"), F.sum(F.col("__n") - 1).alias("n_removed")
    )


def row_checks(rules: QualityRules, seq: str = "seq") -> dict[str, Column]:
    """The checks that look at one row only."""
    return {
        "excluded": mentions_any([F.col(c) for c in rules.text_fields], rules.exclude),
        "undefined": F.col(seq).isNull(),
        "ambiguous": F.coalesce(
            ambiguous_fraction(F.col(seq), rules.ambiguity) > F.lit(rules.max_ambiguous), F.lit(False)
        ),
    }


def adaptive_minimum(
    checked: DataFrame, group: Sequence[str], length: str, rules: QualityRules
) -> DataFrame:
    """Per group: the share of the median in use and the minimum length it gives.

    The median is taken before the ambiguity check; the first share that keeps at
    least one row wins, else the last. Both come from one histogram of lengths.
    """
    usable = ~F.col("undefined") & ~F.col("ambiguous")
    hist = (
        checked.filter(~F.col("excluded") & F.col(length).isNotNull())
        .groupBy(*group, length)
        .agg(F.count(F.lit(1)).alias("cnt"), F.count_if(usable).alias("__ok"))
    )
    ranked = _rank_values(hist.select(*group, length, "cnt"), list(group), length, integral=True)
    longest = hist.groupBy(*group).agg(F.max(F.when(F.col("__ok") > 0, F.col(length))).alias("__longest"))
    med = ranked.groupBy(*group).agg(median_of(length).alias("median_length")).join(longest, list(group))
    effective = [
        F.greatest(F.floor(F.col("median_length") * F.lit(s)).cast("bigint"), F.lit(rules.floor).cast("bigint"))
        for s in MEDIAN_SHARES
    ]
    # a share keeps a row exactly when the longest usable row reaches its minimum
    share, minimum = F.lit(MEDIAN_SHARES[-1]), effective[-1]
    for s, cut in list(zip(MEDIAN_SHARES, effective))[-2::-1]:
        keeps = F.coalesce(F.col("__longest") >= cut, F.lit(False))
        share = F.when(keeps, F.lit(s)).otherwise(share)
        minimum = F.when(keeps, cut).otherwise(minimum)
    return med.select(*group, "median_length", share.alias("share_used"), minimum.alias("min_length_used"))


def assign_reason(
    df: DataFrame,
    group: str | Sequence[str],
    rules: QualityRules,
    seq: str = "seq",
    length: str = "length",
) -> DataFrame:
    """Add qc_reason: excluded_organism, undefined, ambiguity, length or passed.

    The order of the checks is part of the result. With `min_length` unset the
    minimum follows the median of each group.
    """
    return assign_reason_checked(df.withColumns(row_checks(rules, seq)), group, rules, length)


def assign_reason_checked(
    checked: DataFrame, group: str | Sequence[str], rules: QualityRules, length: str = "length"
) -> DataFrame:
    """The same for rows that already carry the row checks (and need no text any more)."""
    group = as_list(group)
    if rules.min_length is not None:
        minimum = max(rules.min_length, rules.floor)
        checked = checked.withColumns(
            {"share_used": F.lit(None).cast("double"), "min_length_used": F.lit(minimum).cast("bigint")}
        )
    else:
        ladder = adaptive_minimum(checked, group, length, rules)
        checked = attach_groups(checked, ladder.drop("median_length"), group)
    reason = (
        F.when(F.col("excluded"), "excluded_organism")
        .when(F.col("undefined"), "undefined")
        .when(F.col("ambiguous"), "ambiguity")
        .when(F.col(length) < F.col("min_length_used"), "length")
        .otherwise("passed")
    )
    return checked.withColumn("qc_reason", reason).drop("excluded", "undefined", "ambiguous")


def passed(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("qc_reason") == "passed").drop("qc_reason")


REASON_COUNTS = {
    "n_excluded_organism": "excluded_organism",
    "n_undefined": "undefined",
    "n_excluded_ambiguity": "ambiguity",
    "n_excluded_length": "length",
    "n_passed": "passed",
}


def breakdown(flagged: DataFrame, family: str = "family", species: str = "species") -> DataFrame:
    """Counts per species, with one total row per family (NULL species)."""
    counts = [F.count_if(F.col("qc_reason") == r).alias(n) for n, r in REASON_COUNTS.items()]
    per_species = flagged.groupBy(family, species).agg(
        *counts, F.max("share_used").alias("share_used")
    )
    sums = [F.sum(n).alias(n) for n in REASON_COUNTS]
    relaxed = F.count_if((F.col("share_used") < MEDIAN_SHARES[0]) & (F.col("n_passed") > 0))
    return (
        per_species.rollup(family, species)
        .agg(*sums, relaxed.alias("n_relaxed"))
        .filter(F.col(family).isNotNull())
    )


def small_groups(
    df: DataFrame, group: str | Sequence[str], reason: str, minimum: int = 4
) -> DataFrame:
    """Groups to skip because fewer than `minimum` rows are left."""
    counts = df.groupBy(*as_list(group)).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") < minimum).withColumn("reason", F.lit(reason))


def without_groups(df: DataFrame, skipped: DataFrame, group: str | Sequence[str]) -> DataFrame:
    return df.join(small_side(skipped), as_list(group), "left_anti")


def flag_length_outliers(
    df: DataFrame,
    group: str | Sequence[str],
    length: str = "length",
    protected: str = "protected",
    high: float = 3.0,
    low: float = 1.0 / 3.0,
    min_rows: int = 2,
) -> DataFrame:
    """Add median_length, group_rows and outlier: long, short, kept_long, kept_short or NULL.

    A bound of 0 or less is off; protected rows are reported (kept_*) but never dropped.
    """
    group = as_list(group)
    med = exact_median(df, group, length, "median_length").withColumnRenamed("n", "group_rows")
    x, m = F.col(length), F.col("median_length")
    active = (F.col("group_rows") >= min_rows) & (m > 0)
    too_long = active & (x > m * F.lit(high)) if high and high > 0 else F.lit(False)
    too_short = active & (x < m * F.lit(low)) if low and low > 0 else F.lit(False)
    side = F.when(too_long, "long").when(too_short, "short")
    flag = F.when(F.col(protected), F.concat(F.lit("kept_"), side)).otherwise(side)
    return attach_groups(df, med, group).withColumn("outlier", flag)


def drop_length_outliers(flagged: DataFrame) -> DataFrame:
    keep = F.col("outlier").isNull() | F.col("outlier").startswith("kept_")
    return flagged.filter(keep).drop("median_length", "group_rows", "outlier")


def outlier_counts(flagged: DataFrame, group: str | Sequence[str]) -> DataFrame:
    return flagged.groupBy(*as_list(group)).agg(
        F.max("median_length").alias("median_length"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("outlier") == "long").alias("n_long"),
        F.count_if(F.col("outlier") == "short").alias("n_short"),
        F.count_if(F.col("outlier").startswith("kept_")).alias("n_protected"),
    )


def attach_by_accession(records: DataFrame, metadata: DataFrame, accession: str = "accession") -> DataFrame:
    """Records with their metadata; records without any are dropped."""
    return records.join(metadata, accession)

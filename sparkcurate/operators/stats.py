"""Length and support summaries, histograms and box-plot rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scale import as_list, attach_groups, median_of, ranked_histogram, value_at


def exclusive_quartile(i: int, value: str) -> Column:
    """Quartile i of 4 by the exclusive rule, as an aggregate over a ranked histogram."""
    n = F.col("n")
    j = F.greatest(F.lit(1), F.least(n - 1, F.floor(F.lit(i) * (n + 1) / 4)))
    d = F.lit(i) * (n + 1) - j * 4
    # d and n are constant inside a group, so any row's value serves
    return (value_at(j, value) * (F.lit(4) - F.max(d)) + value_at(j + 1, value) * F.max(d)) / F.lit(4.0)


def five_number_summary(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    integral: bool = True,
    prefix: str = "",
    mean: bool = True,
) -> DataFrame:
    """min, q1, median, mean, q3, max, iqr at one decimal; fewer than 3 rows collapse to the median."""
    keys = as_list(keys)
    ranked = ranked_histogram(df, keys, value, integral)
    raw = ranked.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.min(value).alias("__min"),
        F.max(value).alias("__max"),
        (F.sum(F.col(value) * F.col("cnt")) / F.sum("cnt")).alias("__mean"),
        median_of(value).alias("__mid"),
        exclusive_quartile(1, value).alias("__q1"),
        exclusive_quartile(2, value).alias("__q2"),
        exclusive_quartile(3, value).alias("__q3"),
    )
    few = F.col("n") < 3
    q1 = F.when(few, F.col("__mid")).otherwise(F.col("__q1"))
    q2 = F.when(few, F.col("__mid")).otherwise(F.col("__q2"))
    q3 = F.when(few, F.col("__mid")).otherwise(F.col("__q3"))
    edge = (lambda c: F.col(c)) if integral else (lambda c: F.bround(F.col(c), 1))
    cols = [
        F.col("n").alias(f"{prefix}n"),
        edge("__min").alias(f"{prefix}min"),
        F.bround(q1, 1).alias(f"{prefix}q1"),
        F.bround(q2, 1).alias(f"{prefix}median"),
        F.bround(q3, 1).alias(f"{prefix}q3"),
        edge("__max").alias(f"{prefix}max"),
        F.bround(q3 - q1, 1).alias(f"{prefix}iqr"),
    ]
    if mean:
        cols.insert(4, F.bround(F.col("__mean"), 1).alias(f"{prefix}mean"))
    return raw.select(*keys, *cols)


def summary_for_groups(summary: DataFrame, groups: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Groups without rows get a summary of NULLs."""
    return groups.join(summary, as_list(keys), "left")


def support_summary(nodes: DataFrame, tree: str = "tree_id", value: str = "confidence") -> DataFrame:
    inner = nodes.filter(~F.col("is_leaf") & F.col(value).isNotNull())
    return five_number_summary(inner, tree, value, integral=False, mean=False)


def histogram(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    bins: int | None = None,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """Counts per bin, the last bin closed.

    Without `low`/`high` the group's own range is used; without `bins` the number
    of bins follows the group size: a third of it, between 5 and 40.
    """
    keys = as_list(keys)
    x = F.col(value).cast("double")
    df = df.filter(F.col(value).isNotNull())
    if low is not None and high is not None:
        # bounded range: rows outside it are not drawn
        df = df.filter(x.between(low, high))
        shaped = df.withColumns({"__lo": F.lit(float(low)), "__hi": F.lit(float(high)), "__bins": F.lit(bins)})
    else:
        ranges = df.groupBy(*keys).agg(
            F.min(x).alias("__lo"), F.max(x).alias("__hi"), F.count(F.lit(1)).alias("__n")
        )
        count = F.lit(bins) if bins else F.least(F.lit(40), F.greatest(F.lit(5), F.floor(F.col("__n") / 3)))
        # a single value gets a unit-wide range centred on it
        flat = F.col("__lo") == F.col("__hi")
        ranges = ranges.select(
            *keys,
            F.when(flat, F.col("__lo") - 0.5).otherwise(F.col("__lo")).alias("__lo"),
            F.when(flat, F.col("__hi") + 0.5).otherwise(F.col("__hi")).alias("__hi"),
            count.cast("int").alias("__bins"),
        )
        shaped = attach_groups(df, ranges, keys, "inner")
    width = (F.col("__hi") - F.col("__lo")) / F.col("__bins")
    slot = F.least(F.floor((x - F.col("__lo")) / width) + 1, F.col("__bins")).cast("int")
    return (
        shaped.withColumn("bin", slot)
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def box_rows(df: DataFrame, keys: str | Sequence[str], value: str, min_rows: int = 5) -> DataFrame:
    """Box per group with at least `min_rows` rows; quartiles interpolate linearly (inclusive rule)."""
    keys = as_list(keys)
    ranked = ranked_histogram(df, keys, value).filter(F.col("n") >= min_rows)

    def at(p: float) -> Column:
        position = (F.col("n") - 1) * F.lit(p)
        low = F.floor(position)
        weight = F.max(position - low)
        below, above = value_at(low + 1, value), value_at(F.least(low + 2, F.col("n")), value)
        return below + (above - below) * weight

    return ranked.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.min(value).alias("low"),
        F.bround(at(0.25), 4).alias("q1"),
        F.bround(at(0.5), 4).alias("median"),
        F.bround(at(0.75), 4).alias("q3"),
        F.max(value).alias("high"),
    )

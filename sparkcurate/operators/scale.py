"""Building blocks that stay distributed when one group holds much of the data.

No function here sorts or collects a whole group in one task: groups are first
reduced by partial aggregation (value histograms, bucket counts) or by a salted
pre-limit, and only the reduced rows meet in a per-group window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage

# Above this limit Spark's own pre-shuffle group limit is switched off
# (default of spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
SALTS = 64
# Groups whose statistics may be broadcast; a row is a key and a few numbers.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


def as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def small_side(df: DataFrame, written: bool = False) -> DataFrame:
    """A join side with one narrow row per group, broadcast when its counted size allows.

    It is written once (unless it already is) and counted. Up to BROADCAST_ROWS rows
    and BROADCAST_BYTES (as JSON) it is broadcast, so the large side is not shuffled on a key that may be hot;
    beyond that the join is an ordinary one, whose hot partitions adaptive execution
    splits.
    """
    df = df if written else cut_lineage(df)
    measured = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("bytes")).first()
    return F.broadcast(df) if measured["n"] <= BROADCAST_ROWS and (measured["bytes"] or 0) <= BROADCAST_BYTES else df


def attach_groups(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Add the statistics of its group to every row of a large table; null keys are a group like any other."""
    renamed = stats.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    return df.join(small_side(renamed), same, how).drop(*(f"__of_{k}" for k in keys))


def spread_scan(df: DataFrame) -> DataFrame:
    """Use all cores for heavy row work on a plain scan of few splits; larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def spread_rows(df: DataFrame, rows: int, few: int = 200_000) -> DataFrame:
    """The same for a join result known to be small in rows; otherwise adaptive execution decides."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if rows <= few else df


def first_k(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str | None = None,
    spread: Column | None = None,
) -> DataFrame:
    """The first k rows of each group.

    Up to GROUP_LIMIT rows Spark drops the rest before the shuffle; beyond it the
    group is first limited inside SALTS slices (`spread` chooses the slice).
    """
    keys = as_list(keys)
    name = rank or "__rank"
    if k > GROUP_LIMIT:
        slice_of = F.pmod(F.xxhash64(spread) if spread is not None else F.xxhash64(*df.columns), F.lit(SALTS))
        local = W.partitionBy(*keys, "__slice").orderBy(*order)
        df = (
            df.withColumn("__slice", slice_of)
            .withColumn("__local", F.row_number().over(local))
            .filter(F.col("__local") <= k)
            .drop("__slice", "__local")
        )
    out = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    out = out.filter(F.col(name) <= k)
    return out if rank else out.drop(name)


def keep_first(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key; copies are dropped before the shuffle."""
    return first_k(df, keys, order, 1)


def value_bucket(value: str, integral: bool) -> Column:
    """Order-preserving coarse bucket: fixed width for integers, log scale otherwise."""
    x = F.col(value)
    if integral:
        return F.floor(x / 4096).cast("bigint")
    size = F.floor(F.log2(F.abs(x).cast("double")) * 1024).cast("bigint")
    # shifted so that tiny magnitudes still sort below large ones on either side of 0
    shifted = F.lit(1 << 21) + size
    return F.when(x > 0, shifted).when(x < 0, -shifted).otherwise(F.lit(0).cast("bigint"))


def ranked_histogram(
    df: DataFrame, keys: str | Sequence[str], value: str, integral: bool = True
) -> DataFrame:
    """Distinct values per group with their count, the rows before them and the group size.

    Columns: keys, value, cnt, before, n. Rows with a NULL value are ignored.
    """
    keys = as_list(keys)
    hist = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt"))
    return _rank_values(hist, keys, value, integral)


def _rank_values(hist: DataFrame, keys: list[str], value: str, integral: bool) -> DataFrame:
    hist = hist.withColumn("__b", value_bucket(value, integral))
    by_key = W.partitionBy(*keys)
    buckets = (
        hist.groupBy(*keys, "__b")
        .agg(F.sum("cnt").alias("__size"))
        .withColumn("n", F.sum("__size").over(by_key))
        .withColumn(
            "__offset",
            F.sum("__size").over(by_key.orderBy("__b").rowsBetween(W.unboundedPreceding, 0)) - F.col("__size"),
        )
        .drop("__size")
    )
    inside = W.partitionBy(*keys, "__b").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    ranked = hist.withColumn("__upto", F.sum("cnt").over(inside))
    joined = ranked.join(buckets, [*keys, "__b"])
    return joined.select(
        *keys, value, "cnt", (F.col("__offset") + F.col("__upto") - F.col("cnt")).alias("before"), "n"
    )


def value_at(rank: Column, value: str) -> Column:
    """Aggregate over a ranked histogram: the value at a 1-based rank."""
    hit = (F.col("before") < rank) & (rank <= F.col("before") + F.col("cnt"))
    return F.max(F.when(hit, F.col(value)))


def median_of(value: str) -> Column:
    """Aggregate over a ranked histogram: mean of the middle two values."""
    low = F.floor((F.col("n") + 1) / 2)
    high = F.floor(F.col("n") / 2) + 1
    return (value_at(low, value) + value_at(high, value)) / F.lit(2.0)


def exact_median(
    df: DataFrame, keys: str | Sequence[str], value: str, name: str = "median", integral: bool = True
) -> DataFrame:
    keys = as_list(keys)
    return ranked_histogram(df, keys, value, integral).groupBy(*keys).agg(
        median_of(value).alias(name), F.max("n").alias("n")
    )


def number_rows(df: DataFrame, keys: str | Sequence[str], lead: Sequence[str], ordinal: str, name: str) -> DataFrame:
    """1-based running number inside each group, ordered by (lead..., ordinal).

    A global sort gives every row a place in its partition; the rows of the group in the partitions before
    turn that into a number without gaps. Tasks hold a range of the sorted rows, whatever the groups are like,
    and the table of offsets has one row per partition and group in it.
    """
    keys = as_list(keys)
    placed = cut_lineage(df.orderBy(*keys, *lead, ordinal).withColumn("__mid", F.monotonically_increasing_id()))
    placed = placed.withColumn("__part", F.shiftright("__mid", 33))
    counts = placed.groupBy(*keys, "__part").agg(F.min("__mid").alias("__first"), F.count(F.lit(1)).alias("__size"))
    order = W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, 0)
    shifts = counts.select(
        *(F.col(k).alias(f"__{k}") for k in keys), F.col("__part").alias("__at"),
        (F.sum("__size").over(order) - F.col("__size") - F.col("__first") + 1).alias("__shift"))
    same = F.col("__part") == F.col("__at")
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"__{key}"))
    joined = placed.join(small_side(shifts), same)
    return joined.select(*df.columns, (F.col("__mid") + F.col("__shift")).alias(name))

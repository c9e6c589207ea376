"""Mixing sources to target weights by subset-sum budget fitting.

Each source has a target number of words. It is met by whole repeats of the source and, for the words
that are left, by a subset of its documents. The subset is fitted on the exact lengths: documents are
counted by (source, length); a first draw takes the same share of every length, a second one fills up
from long to short, and a bounded-knapsack dynamic programme over what is left of the histogram closes
the gap as far as any choice can. Only then are documents chosen: of each length the wanted number, in
the order of a seeded hash.

Scale: only histogram rows (one per distinct length of a source) meet in a task, never documents. The
choice among equal lengths compares ranks inside hash slices, so a length that a third of all documents
share is ranked in many tasks. The dynamic programme covers at most `reach` words whatever the budget.

Edge cases: a null text has size 0 and is taken 0 words; documents of size 0 are never needed; null is a
source of its own, last in the order; repeated rows count each; empty tables give empty results. Rows
with equal ids are told apart by the digest of their text, and equal rows are interchangeable.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.scale import small_side
from .common import Scratch, spare_name

# Cells of a dynamic programme: words, or units of several words while more than that is left.
REACH = 1 << 16
SLICES = 256
WORDS = "[^\\x20\\x09-\\x0D]+"


def word_count(text: str = "text") -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, cap: float = 3.0, cycle: int = 3) -> DataFrame:
    """Targets per source: weights 1, 2, 3, repeating; at most cap times the source, the rest reshared.

    sizes: source, source_size. The level at which the excess settles is the largest L with
    sum(min(L * weight, cap * size)) = total; sources are full in the order of cap * size / weight, so it
    follows from running sums over the sources (one row each). If all are full, each gets its cap.
    """
    by_name = W.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % cycle + 1).cast("double"))
    ranked = ranked.withColumn("full", F.lit(cap) * F.col("source_size")).withColumn("at", F.col("full") / F.col("weight"))
    order = W.orderBy("at", F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(order), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0.0)))
    levels = ranked.withColumn("level", level)
    # The first source in that order that is not full fixes the level for all after it.
    settled = F.min(F.when(F.col("level") < F.col("at"), F.struct("at", "level"))).over(everything)
    target = F.least(F.coalesce(settled["level"] * F.col("weight"), F.col("full")), F.col("full"))
    return levels.withColumn("target", target).select("source", "source_size", "weight", "target")


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, reach: int = REACH) -> np.ndarray:
    """How many documents of each length to take so that their total is as near below budget as can be found."""
    take = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.copy()
    take = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    rest = budget - int((lengths * take).sum())
    order = np.argsort(-lengths, kind="stable")
    for i in order:  # from long to short until the rest is within reach, so that few documents change
        if rest <= reach // 2:
            break
        more = min(int(counts[i] - take[i]), (rest - reach // 2) // int(lengths[i])) if lengths[i] else 0
        take[i] += more
        rest -= more * int(lengths[i])
    # While the rest is still beyond reach, a programme over coarser units: lengths rounded up, so that no sum exceeds it.
    while rest > reach:
        unit = -(-rest // reach)
        more = _knapsack(-(-lengths // unit), counts - take, rest // unit, reach)
        if not more.any():
            break
        take += more
        rest -= int((lengths * more).sum())
    return take + _knapsack(lengths, counts - take, rest, reach)


def _knapsack(lengths: np.ndarray, free: np.ndarray, rest: int, reach: int) -> np.ndarray:
    """Bounded knapsack: the largest sum up to min(rest, reach); counts are split into powers of two."""
    top = min(rest, reach)
    extra = np.zeros(len(lengths), np.int64)
    if top <= 0:
        return extra
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    via = np.full(top + 1, -1, np.int64)
    items: list[tuple[int, int]] = []
    for i in np.argsort(lengths, kind="stable"):
        length, left = int(lengths[i]), int(min(free[i], top // lengths[i])) if lengths[i] else 0
        chunk = 1
        while left > 0 and not reached[top]:
            chunk = min(chunk, left)
            shift = chunk * length
            new = ~reached[shift:] & reached[: top + 1 - shift]
            via[shift:][new] = len(items)
            reached[shift:] |= new
            items.append((int(i), chunk))
            left -= chunk
            chunk *= 2
    at = int(np.flatnonzero(reached)[-1])
    while at > 0:  # a sum was first reached by `via`, its remainder by items before it
        i, chunk = items[via[at]]
        extra[i] += chunk
        at -= chunk * int(lengths[i])
    return extra


def _fit_source(reach: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("size", kind="stable")
        lengths, counts = frame["size"].to_numpy(np.int64), frame["n"].to_numpy(np.int64)
        whole = int((lengths * counts).sum())
        target = float(frame["target"].iloc[0])
        repeats = int(target // whole) if whole else 0
        wanted = fit_counts(lengths, counts, int(round(target - repeats * whole)), reach)
        return frame[["source", "size"]].assign(repeats=repeats, wanted=wanted)

    return run


def mix_sources(docs: DataFrame, keep: list[str], order: list[str], seed: int = 42, cap: float = 3.0,
                reach: int = REACH, text: str = "text", source: str = "source") -> DataFrame:
    """Columns `keep` of docs with size, source_size, target and taken (words of this row in the mix).

    order: columns that identify a document; they seed its place among the documents of its length.
    """
    scratch = Scratch(docs.sparkSession)
    lot = F.xxhash64(F.lit(seed), *(F.col(c) for c in order), F.xxhash64(F.col(text)))
    names = {c: f"__keep{i}" for i, c in enumerate(keep)}
    sized = scratch.store(docs.select(
        *(F.col(c).alias(n) for c, n in names.items()), F.col(source).cast("string").alias("source"),
        word_count(text).alias("size"), lot.alias("lot")))
    histogram = scratch.store(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sizes = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("bigint").alias("source_size"))
    targets = scratch.store(source_targets(sizes, cap))
    same_source = lambda a, b: a["source"].eqNullSafe(b["source"])
    planned = histogram.join(targets, same_source(histogram, targets)).select(
        histogram["source"], "size", "n", "target")
    plan = scratch.store(planned.groupBy("source").applyInPandas(
        _fit_source(reach), "source string, size bigint, repeats bigint, wanted bigint"))
    # Ranks inside (source, size): slices of the seeded order first, then inside the slice that is cut.
    part = F.pmod(F.shiftright("lot", 40), F.lit(SLICES)).cast("int")
    sliced = sized.withColumn("slice", part)
    counts = sliced.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(W.partitionBy("source", "size").orderBy("slice").rowsBetween(W.unboundedPreceding, 0))
    starts = counts.withColumn("before", before - F.col("c"))
    # A slice is taken whole, left out whole, or cut; only cut slices need ranks of their rows.
    cells = starts.join(plan.withColumnsRenamed({"source": "p", "size": "z"}),
                        F.col("source").eqNullSafe(F.col("p")) & (F.col("size") == F.col("z")))
    cells = cells.select("source", "size", "slice", "c", "repeats",
                         F.greatest(F.least(F.col("wanted") - F.col("before"), F.col("c")), F.lit(0)).alias("quota"))
    cells = scratch.store(cells.withColumnsRenamed({"source": "p", "size": "z", "slice": "s"}))
    match = F.col("source").eqNullSafe(F.col("p")) & (F.col("size") == F.col("z")) & (F.col("slice") == F.col("s"))
    ranked = sliced.withColumn("rank", F.row_number().over(
        W.partitionBy("source", "size", "slice").orderBy("lot", *names.values())))
    taken = F.col("size") * (F.col("repeats") + (F.col("rank") <= F.col("quota")).cast("bigint"))
    chosen = ranked.join(cells, match).select(*names.values(), "source", "size", taken.alias("taken"))
    side = small_side(targets.withColumnRenamed("source", "t").drop("weight"), written=True)
    full = chosen.join(side, F.col("source").eqNullSafe(F.col("t")))
    return full.select(*(F.col(n).alias(c) for c, n in names.items()), "size", "source_size", "target",
                       F.col("taken").cast("bigint").alias("taken"))


def mix_rows(docs: DataFrame, id_column: str = "doc_id", seed: int = 42, text: str = "text") -> DataFrame:
    """docs as the mix holds them: each row as often as the mix takes it; rows without words stay once.

    Equal rows (id, text and source) are planned one by one and share what the plan takes of them.
    """
    scratch = Scratch(docs.sparkSession)
    key = F.md5(F.to_json(F.struct(
        F.col(id_column).cast("string").alias("i"), F.col("source").cast("string").alias("s"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("t"))))
    own, turn = spare_name("key", docs), spare_name("turn", docs)
    keyed = docs.withColumn(own, key)
    plan = mix_sources(keyed.select(F.col(own).alias("__key"), F.col(f"`{text}`"), "source"), ["__key"], ["__key"], seed, text=text)
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("taken") / F.greatest("size", F.lit(1))).cast("bigint")
    copies = plan.groupBy("__key").agg(F.sum(times).alias("__times")).filter("__times > 0")
    copies = scratch.store(copies).withColumnsRenamed({"__key": own, "__times": turn})
    once = keyed.dropDuplicates([own]).join(copies, own)
    return once.withColumn(turn, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(turn)))).select(
        *(F.col(f"`{c}`") for c in docs.columns))

"""Robust multivariate outliers: minimum-covariance-determinant estimates per language and source.

Every text gets a few statistics in one pass over the scan. They are transformed to a vector of five
roughly symmetric numbers. For each group (lang, source) the h = ceil(0.75 n) rows whose covariance has
the smallest determinant are approached by concentration steps from two deterministic starts (median and
spread of the coordinates; the shortest halves), the better one is kept, and rows
whose squared Mahalanobis distance to it exceeds a chi-squared limit are rejected.

Scale: a concentration step is one grouped aggregation over the narrow vectors. It counts rows, sums and
products per (group, start, distance bucket), so a group that holds a third of all rows is summed map-side
and nothing of it is sorted or collected. The bucket that holds the h-th row takes part with the fraction
of its rows that is still wanted, so ties and partitioning do not change the estimate. Groups below
`min_rows` rows use the estimate of their language, and those of a small language that of all rows; all
three levels are estimated in the same passes. All rows are used at every size.

Edge cases: a null text has no words and fails the base rule; null lang or source is a group of its own;
repeated rows are all judged; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.scale import small_side
from .common import Scratch, slices

SPACES = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
DIMS = 5
#: Factor that makes the covariance of the inner 75 % of five-dimensional normal vectors that of all of them:
#: 0.75 / P(chi-squared with 7 degrees <= the 75 % point with 5 degrees), Croux and Haesbroeck 1999.
CONSISTENCY = 1.41
# Distance buckets per power of two; the bucket edge decides which rows a step keeps.
RESOLUTION = 32


@dataclass(frozen=True)
class OutlierRules:
    """min_rows: smallest group with its own estimate. floor: least standard deviation per coordinate.

    limit: largest squared Mahalanobis distance kept, after the consistency factor; a five-dimensional normal vector
    exceeds 34 about twice in 10^6, which leaves room for the heavier tails of real statistics.
    """

    share: float = 0.75
    steps: int = 6
    min_rows: int = 25
    floor: tuple[float, ...] = (0.5, 0.1, 0.5, 0.35, 0.12)
    limit: float = 34.0
    min_words: int = 10
    repeat_percent: int = 20


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words covered by windows whose word sequence occurs twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    code, size = seq, 1
    while size < window:  # ranks of longer and longer windows; pairs of ranks are exact, not hashed
        step = min(size, window - size)
        pair = code[: len(code) - step] * len(words) + code[step:]
        code = np.unique(pair, return_inverse=True)[1]
        size += step
    often = np.bincount(code)[code] > 1
    if not often.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """The counts named in BASE for one text."""
    words = text.split()
    if not words:
        return 0, 0, sum(text.count(c) for c in SYMBOLS), 0, 0
    points = len(text.decode("utf-8", "replace"))
    spaces = sum(text.count(c) for c in SPACES)
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip(SPACES):
            seen.add(line)
    return len(words), points - spaces, sum(text.count(c) for c in SYMBOLS), dup, repeated_words(words)


def _counts(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_counts(t) for _, piece in slices(batch.column("__text")) for t in piece]
            columns = [batch.column(c) for c in keep]
            columns += [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(BASE))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *BASE])

    return run


def text_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` of docs and the counts of BASE, one row per row of docs."""
    part = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in part.schema.fields[:-1])
    return part.mapInArrow(_counts(keep), f"{schema}, " + ", ".join(f"{c} bigint" for c in BASE))


def vector() -> list:
    """Transformed statistics: size, word length, symbols, repeated lines, repeated words."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return [
        F.log(words.cast("double")),
        F.log(chars / words),
        F.log1p(1000.0 * F.col("n_symbols") / chars),
        F.log1p(100.0 * F.col("n_dup_lines") / words),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


def _levels(rules: OutlierRules) -> list[tuple[str, list]]:
    """The group keys of the three levels of estimates."""
    return [("group", ["lang", "source"]), ("lang", ["lang"]), ("all", [])]


def _level_rows(rows: DataFrame) -> DataFrame:
    """Each row once per level, with the key of its group on that level as one string."""
    part = lambda c: F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n"))
    keys = F.array(F.to_json(F.array(part("lang"), part("source"))), F.to_json(F.array(part("lang"))), F.lit("[]"))
    return rows.withColumn("key", F.explode(keys))


def _distance(start: str) -> F.Column:
    """(x - centre)' P (x - centre) with the packed upper triangle of P."""
    diff = [F.col(f"x{i}") - F.col(f"{start}.centre")[i] for i in range(DIMS)]
    total, at = None, 0
    for i in range(DIMS):
        for j in range(i, DIMS):
            term = F.col(f"{start}.packed")[at] * diff[i] * diff[j]
            total, at = (term if total is None else total + term), at + 1
    return F.greatest(total, F.lit(0.0))


def _pack(cov: np.ndarray, floor: np.ndarray) -> tuple[list[float], float]:
    """Packed inverse and log determinant of a covariance whose variances are at least floor squared."""
    cov = (cov + cov.T) / 2
    low = np.maximum(floor**2 - np.diag(cov), 0.0)
    cov = cov + np.diag(low + 1e-9)
    inverse = np.linalg.inv(cov)
    weight = np.where(np.eye(DIMS, dtype=bool), 1.0, 2.0)
    return (inverse * weight)[np.triu_indices(DIMS)].tolist(), float(np.linalg.slogdet(cov)[1])


_FIT = "key string, start int, n double, centre array<double>, packed array<double>, logdet double"


def _fit(floor: tuple[float, ...], shrink: float):
    """One row of sums per (key, start) to a centre and a packed inverse covariance."""
    floors = np.array(floor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for row in batch.to_pylist():
                n = max(row["n"], 1e-12)
                centre = np.array(row["sums"]) / n
                cov = np.zeros((DIMS, DIMS))
                cov[np.triu_indices(DIMS)] = row["prods"]
                cov = cov / n
                cov = cov + np.triu(cov, 1).T - np.outer(centre, centre)
                packed, logdet = _pack(cov * shrink, floors)
                values = (row["key"], row["start"], row["n"], centre.tolist(), packed, logdet)
                for column, value in zip(out, values):
                    column.append(value)
            types = [pa.string(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64()]
            names = ["key", "start", "n", "centre", "packed", "logdet"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return run


def _sums(weight: F.Column) -> list:
    """Weighted row count, sums and products as aggregates (arrays built from plain sums)."""
    aggs = [F.sum(weight).alias("n")]
    aggs += [F.sum(weight * F.col(f"x{i}")).alias(f"s{i}") for i in range(DIMS)]
    aggs += [
        F.sum(weight * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i in range(DIMS) for j in range(i, DIMS)
    ]
    return aggs


_SUM_NAMES = [*(f"s{i}" for i in range(DIMS)), *(f"p{i}{j}" for i in range(DIMS) for j in range(i, DIMS))]


def _packed_sums(df: DataFrame) -> DataFrame:
    return df.select(
        "key", "start", "n",
        F.array(*(f"s{i}" for i in range(DIMS))).alias("sums"),
        F.array(*(f"p{i}{j}" for i in range(DIMS) for j in range(i, DIMS))).alias("prods"),
    )


def mcd_estimates(rows: DataFrame, rules: OutlierRules, scratch: Scratch) -> DataFrame:
    """One estimate per key: columns key, total, centre, packed. rows: key parts lang, source and x0..x4."""
    leveled = _level_rows(rows)
    # Start 0: all rows. Start 1: the rows near the coordinate-wise bulk, found with quantile buckets.
    first = leveled.groupBy("key").agg(*_sums(F.lit(1.0))).withColumn("start", F.lit(0))
    spread = scratch.store(_packed_sums(first).mapInArrow(_fit(rules.floor, 1.0), _FIT))
    centre = _bulk(leveled, rules)
    second = centre.join(spread.select("key", "packed"), "key").select(
        "key", F.lit(1).alias("start"), F.lit(0.0).alias("n"), "centre", "packed", F.lit(0.0).alias("logdet"))
    totals = spread.select("key", F.col("n").alias("total"))
    fits = scratch.store(spread.unionByName(second))
    for _ in range(rules.steps):
        fits = _concentrate(leveled, fits, totals, rules, scratch)
    best = fits.groupBy("key").agg(F.min(F.struct("logdet", "start", "centre", "packed")).alias("best"))
    return scratch.store(best.join(totals, "key").select("key", "total", "best.centre", "best.packed"))


def _bulk(leveled: DataFrame, rules: OutlierRules) -> DataFrame:
    """Per key and coordinate the middle of the fullest bucket of the floor's width: a robust mode."""
    width = F.array(*(F.lit(w) for w in rules.floor))
    values = leveled.select("key", F.posexplode(F.array(*(f"x{i}" for i in range(DIMS)))).alias("i", "x"))
    bucket = F.round(F.col("x") / width[F.col("i")]).cast("bigint")
    counted = values.groupBy("key", "i", bucket.alias("b")).agg(F.count(F.lit(1)).alias("c"))
    top = counted.groupBy("key", "i").agg(F.max(F.struct("c", (-F.col("b")).alias("b"))).alias("t"))
    middle = (-F.col("t.b")) * width[F.col("i")]
    placed = top.groupBy("key").agg(*(F.max(F.when(F.col("i") == i, middle)).alias(f"m{i}") for i in range(DIMS)))
    return placed.select("key", F.array(*(f"m{i}" for i in range(DIMS))).alias("centre"))


def _concentrate(
    leveled: DataFrame, fits: DataFrame, totals: DataFrame, rules: OutlierRules, scratch: Scratch
) -> DataFrame:
    """One step: the share of rows nearest to each estimate gives the next estimate."""
    side = fits.select("key", "start", F.struct("centre", "packed").alias("fit"))
    near = leveled.join(small_side(side, written=True), "key").withColumn("d", _distance("fit"))
    bucket = F.floor(F.log2(F.col("d") + 1e-6) * RESOLUTION).cast("bigint")
    cells = scratch.store(near.groupBy("key", "start", bucket.alias("b")).agg(*_sums(F.lit(1.0))))
    # The buckets of a key are few (the exponent range times RESOLUTION), whatever its number of rows.
    upto = F.sum("n").over(W.partitionBy("key", "start").orderBy("b").rowsBetween(W.unboundedPreceding, 0))
    wanted = F.ceil(F.col("total") * rules.share)
    part = F.least(F.greatest((wanted - (F.col("upto") - F.col("n"))) / F.col("n"), F.lit(0.0)), F.lit(1.0))
    kept = cells.join(totals, "key").withColumn("upto", upto).withColumn("w", part).filter("w > 0")
    summed = kept.groupBy("key", "start").agg(
        F.sum(F.col("w") * F.col("n")).alias("n"), *(F.sum(F.col("w") * F.col(c)).alias(c) for c in _SUM_NAMES))
    return scratch.store(_packed_sums(summed).mapInArrow(_fit(rules.floor, 1.0), _FIT))


def reject_outliers(docs: DataFrame, keep: list[str], rules: OutlierRules = OutlierRules()) -> DataFrame:
    """Columns `keep` of docs with the counts of BASE, distance2, base_failed and kept.

    Rows that fail the base rule take no part in the estimates and are never kept.
    """
    scratch = Scratch(docs.sparkSession)
    hidden = docs.withColumns({"__lang": F.col("lang").cast("string"), "__source": F.col("source").cast("string")})
    counted = scratch.store(text_statistics(hidden, [*keep, "__lang", "__source"]))
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    rows = counted.withColumn("base_failed", failed).withColumns({f"x{i}": x for i, x in enumerate(vector())})
    sound = rows.filter(~F.col("base_failed")).select(
        F.col("__lang").alias("lang"), F.col("__source").alias("source"), *(f"x{i}" for i in range(DIMS)))
    estimates = mcd_estimates(sound, rules, scratch)
    # The three keys of each group of rows, resolved to the finest level with enough rows.
    groups = rows.select(F.col("__lang").alias("lang"), F.col("__source").alias("source")).distinct()
    keyed = _level_rows(groups).join(estimates, "key")
    finest = F.when(F.col("key") == "[]", 2).when(F.size(F.from_json("key", "array<string>")) == 1, 1).otherwise(0)
    usable = keyed.filter((F.col("total") >= rules.min_rows) | (F.col("key") == "[]"))
    chosen = usable.groupBy("lang", "source").agg(
        F.min(F.struct(finest.alias("level"), "centre", "packed")).alias("fit"))
    chosen = chosen.withColumnsRenamed({"lang": "__l", "source": "__s"})
    joined = rows.join(
        small_side(chosen), F.col("__lang").eqNullSafe(F.col("__l")) & F.col("__source").eqNullSafe(F.col("__s")), "left")
    squared = F.coalesce(_distance("fit") / CONSISTENCY, F.lit(0.0))
    return joined.withColumn("distance2", squared).select(
        *keep, *BASE, "distance2", "base_failed",
        (~F.col("base_failed") & (F.col("distance2") <= rules.limit)).alias("kept"))

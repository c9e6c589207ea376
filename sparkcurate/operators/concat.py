"""Concatenation of the aligned parts of each genome, alignment checks and statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .qc import flag_length_outliers
from .scale import as_list, attach_groups, small_side

# Changes that a task holds while it adds them up, and letters of a slice of a group that is cut in one task.
HELD_CHANGES = 1 << 20
SLICE_LETTERS = 1 << 23


def raw_concat(genome_markers: DataFrame, keys: Sequence[str] = ("family", "species", "genome_id")) -> DataFrame:
    """Parts of a genome head to tail in marker order, nothing for missing ones."""
    parts = F.array_sort(F.collect_list(F.struct("marker_order", "seq")))
    return genome_markers.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["seq"]), "").alias("seq"))


def flag_marker_outliers(genome_markers: DataFrame, high: float = 3.0, low: float = 0.333, group: Sequence[str] = ("family", "marker")) -> DataFrame:
    """Length outliers among the cells of one marker; the genome itself stays."""
    return flag_length_outliers(genome_markers, group, high=high, low=low, min_rows=1)


def alignment_violations(aligned: DataFrame, group: str | Sequence[str], aln: str = "aln", min_rows: int = 2) -> DataFrame:
    """Alignments with too few rows or rows of different widths."""
    stats = aligned.groupBy(*as_list(group)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.length(aln)).alias("min_width"), F.max(F.length(aln)).alias("max_width")
    )
    reason = F.when(F.col("n_rows") < min_rows, "too few rows").when(F.col("min_width") != F.col("max_width"), "unequal widths")
    return stats.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def marker_blocks(aligned: DataFrame) -> DataFrame:
    """family, marker, marker_order, width, start_col, end_col (1-based, inclusive); empty blocks left out."""
    widths = aligned.groupBy("family", "marker", "marker_order").agg(F.max(F.length("aln")).alias("width"))
    upto = F.sum("width").over(W.partitionBy("family").orderBy("marker_order").rowsBetween(W.unboundedPreceding, 0))
    return (
        widths.filter(F.col("width") > 0)
        .withColumn("end_col", upto)
        .withColumn("start_col", F.col("end_col") - F.col("width") + 1)
    )


def concatenate(aligned: DataFrame, genomes: DataFrame) -> DataFrame:
    """One row per genome: all blocks in marker order, gaps where a marker is missing.

    A genome's own parts and the family's block list become arrays; both are
    bounded by the number of markers, so no genome x marker grid is built. Of several
    parts of one marker in a genome the least text counts.
    """
    blocks = marker_blocks(aligned).groupBy("family").agg(
        F.array_sort(F.collect_list(F.struct("marker_order", "marker", "width"))).alias("blocks")
    )
    parts = aligned.groupBy("family", "genome_id").agg(
        F.array_sort(F.collect_list(F.struct("marker", "aln"))).alias("parts")
    )
    # the block list goes to the genomes: a large family is not shuffled to one task
    joined = genomes.join(parts, ["family", "genome_id"], "left").join(small_side(blocks), "family")
    cell = F.transform(
        "blocks",
        lambda b: F.coalesce(
            F.get(F.filter("parts", lambda p: p["marker"] == b["marker"]), 0)["aln"], F.repeat(F.lit("-"), b["width"])
        ),
    )
    return joined.select(*genomes.columns, F.array_join(cell, "").alias("aln"))


def alignment_stats(aligned: DataFrame, group: str | Sequence[str], ordinal: str, aln: str = "aln") -> DataFrame:
    """Width of the first row and the share of gaps in percent at one decimal."""
    gaps = F.length(aln) - F.length(F.replace(F.col(aln), F.lit("-"), F.lit("")))
    per = aligned.groupBy(*as_list(group)).agg(
        F.min(F.struct(ordinal, F.length(aln).alias("w"))).alias("first"), F.count(F.lit(1)).alias("n"), F.sum(gaps).alias("g")
    )
    width = F.col("first.w")
    pct = F.when(width == 0, F.lit(0.0)).otherwise(F.bround(F.lit(100.0) * F.col("g") / (width * F.col("n")), 1))
    return per.select(*as_list(group), F.col("n").alias("n_rows"), width.alias("length"), pct.alias("gap_pct"))


def _edges(group: list[str], held: int):
    """Where gaps and rows begin and end: group, pos, gaps, rows (changes at that column), added up `held` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, types, parts, waiting = {}, [], [], 0

        def added():
            # group number and column, then the two changes
            at, pos, gaps, rows = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((pos, at))
            at, pos = at[order], pos[order]
            first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (pos[1:] != pos[:-1]))))
            return at[first], pos[first], np.add.reduceat(gaps[order], first), np.add.reduceat(rows[order], first)

        def made(at, pos, gaps, rows):
            keys = list(numbers)
            columns = [pa.array([k[i] for k in keys], t).take(pa.array(at)) for i, t in enumerate(types)]
            return pa.RecordBatch.from_arrays([*columns, *map(pa.array, (pos, gaps, rows))], [*group, "pos", "gaps", "rows"])

        for batch in batches:
            types = [batch.schema.field(c).type for c in group]
            for i in range(batch.num_rows):
                aln = batch.column("__aln")[i].as_py()
                if not aln:
                    continue
                number = numbers.setdefault(tuple(batch.column(c)[i].as_py() for c in group), len(numbers))
                gap = np.zeros(len(aln) + 2, np.int8)
                gap[1:-1] = np.frombuffer(aln.encode("utf-32-le", "surrogatepass"), np.uint32) == ord("-")
                step = np.diff(gap)
                turns = np.flatnonzero(step)
                pos = np.concatenate((turns + 1, [1, len(aln) + 1]))
                gaps, rows = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
                gaps[: len(turns)], rows[len(turns) :] = step[turns], (1, -1)
                parts.append((np.full(len(pos), number), pos, gaps, rows))
                waiting += len(pos)
                if waiting >= held:
                    parts = [added()]
                    waiting = len(parts[0][0])
                    if waiting >= held // 2:  # adding up no longer helps
                        yield made(*parts[0])
                        numbers, parts, waiting = {}, [], 0
        if parts:
            yield made(*added())

    return run


def gap_segments(aligned: DataFrame, group: str | Sequence[str], aln: str = "aln") -> DataFrame:
    """Stretches of columns with the same gaps: group, start, stop (1-based, inclusive), gaps, rows.

    A row adds its runs of gaps as a beginning and an end, and a running sum over those columns where anything changes
    gives the counts: the work grows with the runs and not with the characters. Rows may be of unequal width.
    """
    group = as_list(group)
    part = aligned.select(*group, F.col(aln).alias("__aln"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in part.schema.fields[:-1])
    edges = part.mapInArrow(_edges(group, HELD_CHANGES), f"{fields}, pos bigint, gaps bigint, rows bigint")
    steps = edges.groupBy(*group, "pos").agg(F.sum("gaps").alias("gaps"), F.sum("rows").alias("rows"))
    along = W.partitionBy(*group).orderBy("pos")
    so_far = along.rowsBetween(W.unboundedPreceding, 0)
    return steps.select(
        *group, F.col("pos").alias("start"), (F.lead("pos").over(along) - 1).alias("stop"),
        F.sum("gaps").over(so_far).alias("gaps"), F.sum("rows").over(so_far).alias("rows")).filter("rows > 0")


def column_profile(aligned: DataFrame, group: str | Sequence[str], aln: str = "aln") -> DataFrame:
    """Share of gaps per alignment column (pos is 1-based)."""
    group = as_list(group)
    pos = F.explode(F.sequence(F.col("start").cast("int"), F.col("stop").cast("int"))).alias("pos")
    return gap_segments(aligned, group, aln).select(*group, pos, (F.col("gaps") / F.col("rows")).alias("gap_fraction"))


def _cut(aln: str, names: list[str]):
    """The kept stretches of the rows of one slice, joined."""

    def run(rows: pa.Table, plan: pa.Table) -> pa.Table:
        start, stop = (plan.column(c).to_numpy().astype(np.int64) for c in ("start", "stop"))
        turns = np.zeros(stop.max(initial=0) + 1, np.int8)
        turns[start - 1], turns[stop] = 1, -1
        kept = np.cumsum(turns[:-1], dtype=np.int8).astype(bool)
        cut = []
        for text in rows.column(aln).to_pylist():
            if text:
                letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)[: len(kept)]
                text = letters[kept[: len(letters)]].tobytes().decode("utf-32-le", "surrogatepass")
            cut.append(text)
        width = pa.array(np.full(rows.num_rows, kept.sum(), np.int32))
        new = {aln: pa.array(cut, pa.string()), "width_after": width}
        return pa.table([new[c] if c in new else rows.column(c) for c in names], names)

    return run


def trim_gappy_columns(aligned: DataFrame, group: str | Sequence[str], max_gap: float, aln: str = "aln") -> DataFrame:
    """Drop the columns whose share of gaps exceeds `max_gap`; adds width_before and width_after.

    width_after is the width of the trimmed alignment; a row that was shorter than it stays shorter. A group is
    cut in slices of about SLICE_LETTERS; the kept stretches go to its slices and not to its rows.
    """
    group = as_list(group)
    along = W.partitionBy(*group).orderBy("start")
    marked = gap_segments(aligned, group, aln).withColumn("__keep", F.col("gaps") / F.col("rows") <= max_gap)
    turn = (F.col("__keep") != F.lag("__keep", 1, False).over(along)).cast("int")
    stretches = marked.withColumn("__turn", turn).withColumn(
        "__stretch", F.sum("__turn").over(along.rowsBetween(W.unboundedPreceding, 0)))
    stretches = stretches.groupBy(*group, "__stretch").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("__keep").alias("__keep"))
    letters = F.sum(F.coalesce(F.length(aln), F.lit(0)) + 1)
    slices = cut_lineage(aligned.groupBy(*group).agg(F.ceil(letters / SLICE_LETTERS).cast("bigint").alias("__slices")))
    plan = attach_groups(stretches.filter("__keep").select(*group, "start", "stop"), slices, group)
    plan = plan.withColumn("__slice", F.explode(F.sequence(F.lit(0), F.col("__slices") - 1))).drop("__slices")
    rows = attach_groups(aligned, slices, group).withColumn("width_before", F.length(aln))
    names = [*aligned.columns, "width_before", "width_after"]
    dealt = rows.withColumn("__slice", F.pmod(F.xxhash64(*aligned.columns), F.col("__slices"))).drop("__slices")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.drop("__slice").schema.fields)
    keys = [*group, "__slice"]
    return dealt.groupBy(*keys).cogroup(plan.groupBy(*keys)).applyInArrow(_cut(aln, names), f"{fields}, width_after int")

"""Best-fit-decreasing packing of indivisible groups into shards of near-equal bytes.

Rows with equal texts form a group that stays together. Groups are packed in two levels, both by best
fit decreasing with a balanced tree of remaining capacities: cells of groups are packed into bundles,
then bundles into shards. The capacity of the shards is the least at which the packing needs no more
than the wanted number (bisection). A group that is larger than a fair share gets a shard of its own,
and the other shards share the rest evenly.

Scale: a cell is a hash slice of the groups, about `cell_groups` rows of (digest, size), read in order
of size from a sorted partition; a task holds the open bins of one cell only. The driver sees bundles,
of which there are at most `bundles` for each shard and two for each cell, never groups or rows. The
number of cells is limited by `max_cells`. Copies of one text are counted map-side.

Edge cases: a null text is packed as an empty one (size 1); repeated rows are counted and returned each;
an empty table gives an empty result; with fewer groups than shards some shards stay empty.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.scale import small_side
from .common import Scratch, spare_name, text_digest, text_or_empty

#: Groups per cell, cells at most, bundles per shard.
CELL_GROUPS = 20_000
MAX_CELLS = 4096
BUNDLES = 256
SLOT_ROWS = 5_000


class CapacityTree:
    """Open bins by remaining capacity: a height-balanced tree of sorted leaves with bounded fanout.

    `tightest(size)` is the bin with the least remaining capacity that still takes size. Leaves split
    when they are full, so insertion and removal move a bounded number of entries.
    """

    FANOUT = 256

    def __init__(self) -> None:
        self.leaves: list[list[tuple[int, int]]] = [[]]
        self.highs: list[tuple[int, int]] = [(1 << 62, 0)]

    def add(self, room: int, bin_no: int) -> None:
        at = bisect_left(self.highs, (room, bin_no))
        leaf = self.leaves[at]
        insort(leaf, (room, bin_no))
        if len(leaf) > self.FANOUT:
            half = len(leaf) // 2
            self.leaves[at : at + 1] = [leaf[:half], leaf[half:]]
            self.highs.insert(at, leaf[half - 1])

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) of the tightest bin with room >= size."""
        at = bisect_left(self.highs, (size, -1))
        while at < len(self.leaves):
            leaf = self.leaves[at]
            i = bisect_left(leaf, (size, -1))
            if i < len(leaf):
                found = leaf.pop(i)
                if not leaf and len(self.leaves) > 1 and at < len(self.leaves) - 1:
                    del self.leaves[at], self.highs[at]
                return found
            at += 1
        return None


class BestFit:
    """Best fit of sizes that come in decreasing order; a bin of its own for what exceeds the capacity."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.open = capacity, 0, CapacityTree()

    def place(self, size: int) -> int:
        found = self.open.tightest(size)
        room, bin_no = found if found else (max(self.capacity, size), self.bins)
        self.bins += found is None
        if room > size:
            self.open.add(room - size, bin_no)
        return bin_no


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    pack, out = BestFit(capacity), [0] * len(sizes)
    for i in order:
        out[i] = pack.place(sizes[i])
    return out


def pack_into(sizes: list[int], shards: int) -> list[int]:
    """Best fit decreasing into at most `shards` bins of the least capacity that is enough."""
    out = [-1] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    rest, first = sum(sizes), 0
    # What is larger than a fair share of the rest can't share a shard without unbalancing it.
    while first < len(order) and first < shards - 1 and sizes[order[first]] * (shards - first) > rest:
        out[order[first]] = first
        rest -= sizes[order[first]]
        first += 1
    left, bins = order[first:], shards - first
    if not left:
        return out
    part = [sizes[i] for i in left]
    low, high = max(max(part), -(-rest // bins)), rest
    while low < high:
        middle = (low + high) // 2
        if max(best_fit_decreasing(part, middle)) < bins:
            high = middle
        else:
            low = middle + 1
    for i, b in zip(left, best_fit_decreasing(part, high)):
        out[i] = first + b
    return out


def _cell_packer(capacity: int):
    """Rows sorted by (cell, size descending): the bundle of each group, cells one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, pack = None, BestFit(capacity)
        for batch in batches:
            bundles = []
            for c, size in zip(batch.column("cell").to_pylist(), batch.column("bytes").to_pylist()):
                if c != cell:
                    cell, pack = c, BestFit(capacity)
                bundles.append(pack.place(size))
            columns = [batch.column("digest"), batch.column("bytes"), batch.column("cell"), pa.array(bundles, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "bytes", "cell", "bundle"])

    return run


def pack_groups(groups: DataFrame, shards: int, scratch: Scratch) -> DataFrame:
    """groups: digest, bytes (one row each). Returns digest, shard."""
    spark = groups.sparkSession
    found = groups.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("total")).first()
    total = int(found["total"] or 0)
    cells = max(1, min(MAX_CELLS, -(-found["n"] // CELL_GROUPS)))
    capacity = max(1, total // (shards * BUNDLES))
    cell = F.pmod(F.xxhash64("digest"), F.lit(cells)).cast("int")
    dealt = groups.withColumn("cell", cell).repartition(cells, "cell")
    ordered = dealt.sortWithinPartitions("cell", F.col("bytes").desc(), "digest").select("digest", "bytes", "cell")
    packed = scratch.store(ordered.mapInArrow(
        _cell_packer(capacity), "digest binary, bytes bigint, cell int, bundle int"))
    bundles = packed.groupBy("cell", "bundle").agg(F.sum("bytes").alias("bytes")).orderBy("cell", "bundle").collect()
    chosen = pack_into([int(b["bytes"]) for b in bundles], shards)
    placed = spark.createDataFrame(
        [(b["cell"], b["bundle"], s) for b, s in zip(bundles, chosen)], "cell int, bundle int, shard int")
    return packed.join(small_side(placed), ["cell", "bundle"]).select("digest", "shard")


def number_slots(rows: DataFrame, order: list[str], n_rows: int) -> DataFrame:
    """Add `slot`: gapless numbers from 0 inside each shard, counted in hash slices and shifted."""
    parts = max(1, -(-n_rows // SLOT_ROWS))
    rows = rows.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("bigint"))
    counts = rows.groupBy("shard", "__part").agg(F.count(F.lit(1)).alias("__c"))
    before = F.sum("__c").over(W.partitionBy("shard").orderBy("__part").rowsBetween(W.unboundedPreceding, 0))
    starts = counts.select("shard", "__part", (before - F.col("__c")).alias("__start"))
    rank = F.row_number().over(W.partitionBy("shard", "__part").orderBy(*order))
    numbered = rows.withColumn("__rank", rank).join(starts, ["shard", "__part"])
    return numbered.withColumn("slot", (F.col("__start") + F.col("__rank") - 1).cast("bigint")).drop(
        "__part", "__rank", "__start")


def shard_documents(docs: DataFrame, keep: list[str], order: list[str], shards: int = 16, text: str = "text") -> DataFrame:
    """Columns `keep` of docs with size, text_crc32, shard and slot."""
    scratch = Scratch(docs.sparkSession)
    names = {c: f"__keep{i}" for i, c in enumerate(keep)}
    rows = scratch.store(docs.select(
        *(F.col(c).alias(n) for c, n in names.items()),
        *(F.col(c).alias(f"__order{i}") for i, c in enumerate(order)),
        (F.octet_length(text_or_empty(text)) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text_or_empty(text), "UTF-8")).cast("bigint").alias("text_crc32"),
        text_digest(text).alias("digest")))
    groups = scratch.store(rows.groupBy("digest").agg(
        F.sum("size").cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("copies")))
    placed = pack_groups(groups.select("digest", "bytes"), shards, scratch)
    in_shards = scratch.store(rows.join(placed, "digest").drop("digest"))
    n_rows = int(groups.agg(F.sum("copies")).first()[0] or 0)
    by = [*(f"__order{i}" for i in range(len(order))), "text_crc32"]
    numbered = number_slots(in_shards, by, n_rows)
    return numbered.select(*(F.col(n).alias(c) for c, n in names.items()), "size", "text_crc32", "shard", "slot")


def assign_shards(docs: DataFrame, shards: int = 16, text: str = "text") -> DataFrame:
    """docs with a column `shard`, in place of one of that name; the texts are shuffled once, by their digest."""
    scratch = Scratch(docs.sparkSession)
    size = (F.octet_length(text_or_empty(text)) + 1).cast("bigint")
    groups = scratch.store(docs.select(text_digest(text).alias("digest"), size.alias("size")).groupBy("digest").agg(
        F.sum("size").cast("bigint").alias("bytes")))
    digest, number = spare_name("digest", docs), spare_name("shard", docs)
    placed = scratch.store(pack_groups(groups, shards, scratch)).withColumnsRenamed({"digest": digest, "shard": number})
    joined = docs.withColumn(digest, text_digest(text)).join(placed, digest)
    kept = [c for c in docs.columns if c.lower() != "shard"]
    return joined.select(*(F.col(f"`{c}`") for c in kept), F.col(number).alias("shard"))

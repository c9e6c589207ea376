"""Merkle manifest of a dataset: one tree per group, stored as blocks in van Emde Boas order.

The leaves of a group are numbered from 0 in order; while more than one node remains, each run of eight
consecutive nodes (the last may be shorter, even one) becomes the hash of their hex digests. A tree is cut
into aligned blocks of HEIGHT levels above their leaves. The nodes of a block lie in one array in van Emde
Boas order: a subtree is split at half its height, the top part is stored first and the bottom parts
follow from left to right, each split in the same way. `addresses` computes the place of any node from its
level and index alone; both the construction and the retrieval of siblings use it, and neither needs a
pointer or an index table. The roots of the blocks are the leaves of the next storey, and so on until one
root is left; the roots of all groups, in order of the groups, form one more tree in the same way.

Scale: numbers come from a global sort and per-partition counts, a task holds one block (at most 8^HEIGHT
leaves) at a time, and a storey has 8^HEIGHT times fewer rows than the one below. The way down joins each
block to its children, so an upper path reaches the leaves as one row per block, never per document.

Edge cases: null in a column is hashed as `-`, an empty text as `0:`; a group of one leaf has that leaf as
its root and no siblings of its own; an empty table gives empty results. Rows with equal order are ordered
by leaf; equal rows have equal leaves, so their order does not matter. Extra columns play no part.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.scale import small_side
from .common import Scratch

ARITY = 8
#: Levels of a block above its leaves; with the leaves an even number, so that half height is whole.
HEIGHT = 3
DIGITS = 64
PATH = "array<struct<slot: int, run: binary>>"


# --------------------------------------------------------------------------
# layout of one block


def _nodes(height: int) -> int:
    """Nodes of a full subtree with that many levels of nodes."""
    return (ARITY**height - 1) // (ARITY - 1)


def addresses(height: int, depth: int, index: np.ndarray | int) -> np.ndarray | int:
    """Places in van Emde Boas order of the nodes `index` of one depth (0: the root) in a subtree of `height` levels."""
    base = index * 0
    while height > 1:
        top = height // 2
        if depth < top:
            height = top
            continue
        # Which of the bottom subtrees, and where in it.
        below = ARITY ** (depth - top)
        base = base + _nodes(top) + (index // below) * _nodes(height - top)
        index, depth, height = index % below, depth - top, height - top
    return base


def node_hash(digests: list[bytes]) -> bytes:
    return sha256(b"".join(digests)).hexdigest().encode()


class Block:
    """The nodes of one aligned subtree; `levels` above `count` leaves."""

    def __init__(self, levels: int, count: int, store: np.ndarray):
        self.levels, self.count, self.store = levels, count, store

    @classmethod
    def build(cls, leaves: list[bytes], levels: int) -> Block:
        block = cls(levels, len(leaves), np.zeros(_nodes(levels + 1), f"S{DIGITS}"))
        nodes = leaves
        block.put(0, nodes)
        for level in range(1, levels + 1):
            nodes = [node_hash(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
            block.put(level, nodes)
        return block

    def put(self, level: int, nodes: list[bytes]) -> None:
        self.store[addresses(self.levels + 1, self.levels - level, np.arange(len(nodes)))] = nodes

    def width(self, level: int) -> int:
        """Nodes on one level: the last run may be short."""
        return -(-self.count // ARITY**level)

    def run(self, level: int, first: int) -> bytes:
        """The digests of the run that starts at node `first` of a level, joined."""
        index = np.arange(first, min(first + ARITY, self.width(level)))
        return self.store[addresses(self.levels + 1, self.levels - level, index)].tobytes()

    @property
    def root(self) -> bytes:
        return bytes(self.store[addresses(self.levels + 1, 0, 0)])

    def runs(self) -> list[list[bytes]]:
        """All runs of all levels below the root."""
        return [[self.run(level, i) for i in range(0, self.width(level), ARITY)] for level in range(self.levels)]


def path_of(leaf: int, runs: list[list[bytes]]) -> list[tuple[int, bytes]]:
    """(place in its run, run) on every level from a leaf of a block up to its root."""
    out = []
    for level in runs:
        out.append((leaf % ARITY, level[leaf // ARITY]))
        leaf //= ARITY
    return out


def siblings(slot: int, run: bytes) -> bytes:
    return run[: slot * DIGITS] + run[(slot + 1) * DIGITS :]


def fold(leaf: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that follows from a leaf and the siblings on its path."""
    for slot, run in path:
        leaf = sha256(run[: slot * DIGITS] + leaf + run[(slot + 1) * DIGITS :]).hexdigest().encode()
    return leaf


# --------------------------------------------------------------------------
# blocks of all trees


def numbered(leaves: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """leaves with `at`, the number from 0 in its group `g`, and `n`, the size of the group.

    A global sort numbers the rows of each partition; the first number of a group in a partition and the
    rows of the group in the partitions before turn that into one without gaps.
    """
    placed = scratch.store(leaves.orderBy("g", *order).withColumn("__mid", F.monotonically_increasing_id()))
    part = F.shiftright("__mid", 33).alias("__part")
    counts = placed.groupBy("g", part).agg(F.min("__mid").alias("__first"), F.count(F.lit(1)).alias("__c"))
    by_group = W.partitionBy("g")
    before = F.sum("__c").over(by_group.orderBy("__part").rowsBetween(W.unboundedPreceding, 0)) - F.col("__c")
    spans = counts.select(
        "g", "__part", (before - F.col("__first")).alias("__shift"), F.sum("__c").over(by_group).alias("n"))
    joined = placed.withColumn("__part", part).join(small_side(scratch.store(spans), written=True), ["g", "__part"])
    return joined.withColumn("at", F.col("__mid") + F.col("__shift")).drop("__mid", "__part", "__shift")


def _levels(n: int) -> int:
    """Levels above n leaves."""
    levels = 0
    while ARITY**levels < n:
        levels += 1
    return levels


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    """One block: its nodes in van Emde Boas order and its root."""
    rows = rows.sort_by("at")
    levels = min(HEIGHT, _levels(rows.column("n")[0].as_py()))
    block = Block.build([d.encode() for d in rows.column("digest").to_pylist()], levels)
    return pa.table({
        "g": [key[0].as_py()], "block": [key[1].as_py()], "levels": pa.array([levels], pa.int32()),
        "count": pa.array([block.count], pa.int32()), "n": [rows.column("n")[0].as_py()],
        "root": [block.root.decode()], "nodes": pa.array([block.store.tobytes()], pa.binary())})


BLOCK_SCHEMA = "g string, block bigint, levels int, count int, n bigint, root string, nodes binary"


def block_of() -> Column:
    return F.floor(F.col("at") / ARITY**HEIGHT).cast("bigint").alias("block")


def build_storeys(leaves: DataFrame, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """leaves: g, at, n, digest. The blocks of each storey from the leaves up, and the root of each group (g, digest)."""
    storeys, rows = [], leaves.select("g", "at", "n", "digest")
    while True:
        blocks = scratch.store(rows.groupBy("g", block_of()).applyInArrow(_build, BLOCK_SCHEMA))
        storeys.append(blocks)
        above = blocks.filter(F.col("n") > ARITY**HEIGHT).select(
            "g", F.col("block").alias("at"), F.ceil(F.col("n") / ARITY**HEIGHT).cast("bigint").alias("n"),
            F.col("root").alias("digest"))
        if above.isEmpty():
            break
        rows = above
    tops = [s.filter(F.col("n") <= ARITY**HEIGHT).select("g", F.col("root").alias("digest")) for s in storeys]
    roots = tops[0]
    for top in tops[1:]:
        roots = roots.unionByName(top)
    return storeys, roots


def _unpack(row: dict) -> Block:
    return Block(row["levels"], row["count"], np.frombuffer(row["nodes"], f"S{DIGITS}"))


def _descend(children: pa.Table, blocks: pa.Table) -> pa.Table:
    """The path of each child of one block: through the block and on to the root of all."""
    block = blocks.to_pylist()[0]
    runs = _unpack(block).runs()
    above = [(s["slot"], s["run"]) for s in block["above"]]
    paths = [
        [{"slot": s, "run": r} for s, r in path_of(at % ARITY**HEIGHT, runs) + above]
        for at in children.column("at").to_pylist()]
    return children.select(["g", "at"]).append_column("above", pa.array(paths, pa.list_(pa.struct(
        [("slot", pa.int32()), ("run", pa.binary())]))))


def paths_down(storeys: list[DataFrame], above: DataFrame, scratch: Scratch) -> DataFrame:
    """above: g, above (the path from the root of each group). Returns the lowest blocks with the path of each.

    Goes from the highest storey down; a group whose tree ends on a lower storey enters there.
    """
    lower = None
    for i in range(len(storeys) - 1, -1, -1):
        last = storeys[i].filter(F.col("n") <= ARITY**HEIGHT).join(small_side(above, written=True), "g")
        entered = last if lower is None else last.unionByName(
            storeys[i].join(lower.withColumnRenamed("at", "block"), ["g", "block"]))
        blocks = scratch.store(entered)
        if not i:
            return blocks
        children = storeys[i - 1].filter(F.col("n") > ARITY**HEIGHT).select("g", F.col("block").alias("at"))
        lower = children.groupBy("g", block_of()).cogroup(blocks.groupBy("g", "block")).applyInArrow(
            _descend, f"g string, at bigint, above {PATH}")


def _prove(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
    """For each leaf of one lowest block: proof, and the root folded from the leaf that is presented."""
    block = blocks.to_pylist()[0]
    runs = _unpack(block).runs()
    above = [(s["slot"], s["run"]) for s in block["above"]]
    # What lies above the block is the same for all its leaves; the last run holds the children of the root.
    shared = b"".join(siblings(s, r) for s, r in above)
    top = node_hash([above[-1][1]]).decode() if above else block["root"]
    proofs, folded = [], []
    for at, presented in zip(leaves.column("at").to_pylist(), leaves.column("presented").to_pylist()):
        path = path_of(at % ARITY**HEIGHT, runs)
        proofs.append(sha256(b"".join(siblings(s, r) for s, r in path) + shared).hexdigest())
        folded.append(fold(presented.encode(), path + above).decode())
    kept = [c for c in leaves.column_names if c.startswith("__keep")]
    size = leaves.num_rows
    return leaves.select([*kept, "digest"]).append_column("subroot", pa.array([block["subroot"]] * size)).append_column(
        "top", pa.array([top] * size)).append_column("proof", pa.array(proofs)).append_column(
        "folded", pa.array(folded))


# --------------------------------------------------------------------------
# documents


def field(column: Column) -> Column:
    """`-` for null, else UTF-8 byte count, `:` and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def manifest(leaves: DataFrame, group: str, order: list[str], keep: list[str], digest: str, presented: str | None = None) -> DataFrame:
    """One row per row of leaves: `keep`, leaf, subroot, root, proof_sha256, folded_root, verified.

    `digest` holds the hex digest of each leaf and `presented` the one that somebody claims now; the folded root
    follows from the claimed leaf and the stored siblings, and is equal to the root only if nothing changed.
    """
    scratch = Scratch(leaves.sparkSession)
    names = {c: f"__keep{i}" for i, c in enumerate(keep)}
    # A null group sorts first: the empty string; all others start with a sign.
    g = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("g")
    rows = leaves.select(
        g, *(F.col(f"`{c}`").alias(n) for c, n in names.items()),
        *(F.col(f"`{c}`").alias(f"__order{i}") for i, c in enumerate(order)),
        F.col(f"`{digest}`").alias("digest"), F.col(f"`{presented or digest}`").alias("presented"))
    rows = scratch.store(numbered(rows, [*(f"__order{i}" for i in range(len(order))), "digest"], scratch))
    storeys, roots = build_storeys(rows, scratch)
    roots = scratch.store(roots)
    # The tree over the groups: its leaves are their roots.
    ranked = scratch.store(numbered(roots.select(F.lit("").alias("g"), F.col("g").alias("group"), "digest"), ["group"], scratch))
    upper, root = build_storeys(ranked, scratch)
    none = scratch.store(root.select("g", F.expr(f"CAST(array() AS {PATH})").alias("above")))
    top_blocks = paths_down(upper, none, scratch)
    led = ranked.groupBy("g", block_of()).cogroup(top_blocks.groupBy("g", "block")).applyInArrow(
        _descend, f"g string, at bigint, above {PATH}")
    named = scratch.store(ranked.join(led, ["g", "at"]).select(F.col("group").alias("g"), "above"))
    ends = roots.select("g", F.col("digest").alias("subroot"))
    blocks = scratch.store(paths_down(storeys, named, scratch).join(small_side(ends, written=True), "g"))
    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names.values())
    proven = rows.groupBy("g", block_of()).cogroup(blocks.groupBy("g", "block")).applyInArrow(
        _prove, f"{schema}, digest string, subroot string, top string, proof string, folded string")
    return proven.select(
        *(F.col(n).alias(c) for c, n in names.items()), F.col("digest").alias("leaf"), "subroot", F.col("top").alias("root"),
        F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("top")).alias("verified"))


CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: str = "text") -> Column:
    """The text with A-Z in lower case, all other letters as they are."""
    return F.translate(F.col(f"`{text}`"), CAPITALS, CAPITALS.lower())


def document_manifest(docs: DataFrame, columns: list[str], group: str, order: list[str], tampered: Column) -> DataFrame:
    """The manifest of documents, with the columns `order`; where `tampered` holds, `text` is presented in lower case."""
    plain = [field(F.col(f"`{c}`")) for c in columns]
    changed = [field(lowered(c) if c == "text" else F.col(f"`{c}`")) for c in columns]
    leaves = docs.select(
        F.col(f"`{group}`").alias("group"), *(F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)),
        F.sha2(F.concat(*plain), 256).alias("leaf"), F.when(tampered, F.sha2(F.concat(*changed), 256)).alias("other"))
    leaves = leaves.withColumn("presented", F.coalesce("other", "leaf"))
    names = {f"o{i}": c for i, c in enumerate(order)}
    out = manifest(leaves, "group", list(names), list(names), "leaf", "presented")
    return out.withColumnsRenamed(names)

"""Suffix-array deduplication with deep-shallow sorting: byte strings that start in more than one place go.

Blocks of windows that repeat as a whole are found by counting (see recurrence.py). Where blocks with the
same anchor differ somewhere, their suffixes from the anchor on are sorted the deep-shallow way (Manzini
and Ferragina, 2004): multikey quicksort on eight bytes at a time to a shallow depth, then a blind trie for each
group that is still equal there, which orders its long common prefixes with one comparison of texts per
suffix. Two windows that start `o` bytes before their anchors are equal if the suffixes agree in
length - o bytes and the texts before the anchors in o bytes. Both are runs in a sorted array of which
neighbours share that many bytes, so the equal windows of all offsets are counted without pairs.

Scale: cells of one anchor are sorted together, many cells per task, about `CELL_ROWS` suffixes at a time.
A gram with more different blocks than that is not sorted in one task: its windows are counted as
128-bit hashes in an aggregation, which gives the same result.

Edge cases: null and empty texts have no bytes; copies of a text of `length` bytes or more are removed
whole; a string may overlap its own repetition; texts end matches; empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices
from .recurrence import Scheme, covered, find_blocks, prepared, range_arrays, ranges_of, texts_of, windows_in_parts

GRAM = 16
SHALLOW = 24
CELL_ROWS = 20_000


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    top = min(len(a), len(b))
    if a[:top] == b[:top]:
        return top
    low = 0
    while top - low > 1:
        middle = (low + top) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            top = middle
    return low


class BlindTrie:
    """A Patricia trie: nodes know a depth and branch on the byte there; texts are read at the leaves only."""

    def __init__(self, texts: list[bytes], first: int):
        self.texts = texts
        self.root: list = [0, {}, None]  # depth, children by byte (-1: the text ends), leaf
        self.root = self._leaf(first)

    def _leaf(self, i: int) -> list:
        return [len(self.texts[i]), None, [i]]

    def _byte(self, i: int, depth: int) -> int:
        text = self.texts[i]
        return text[depth] if depth < len(text) else -1

    def add(self, i: int) -> None:
        path, node = [], self.root
        while node[1] is not None:  # blind: bytes between the branches are not looked at
            path.append(node)
            node = node[1].get(self._byte(i, node[0])) or next(iter(node[1].values()))
        other = node[2][0]
        depth = common_prefix(self.texts[i], self.texts[other])
        if depth == len(self.texts[i]) == len(self.texts[other]):
            node[2].append(i)
            return
        above = None
        for step in path:
            if step[0] >= depth:
                node = step
                break
            above = step
        if node[1] is not None and node[0] == depth:
            node[1][self._byte(i, depth)] = self._leaf(i)
            return
        fork = [depth, {self._byte(other, depth): node, self._byte(i, depth): self._leaf(i)}, None]
        if above is None:
            self.root = fork
        else:
            above[1][self._byte(i, above[0])] = fork

    def ordered(self) -> tuple[list[int], list[int]]:
        """Texts in order, and the common prefix of each with the one before (0 for the first)."""
        order, shared = [], []
        stack: list[tuple[list, int]] = [(self.root, 0)]
        while stack:
            node, above = stack.pop()
            if node[1] is None:
                for n, i in enumerate(node[2]):
                    order.append(i)
                    shared.append(len(self.texts[i]) if n else above)
                continue
            for n, byte in reversed(list(enumerate(sorted(node[1])))):
                stack.append((node[1][byte], node[0] if n else above))
        return order, shared


def _super(texts: list[bytes], rows: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes of each text from depth on, as comparable numbers (zero bytes beyond the end)."""
    return np.array([int.from_bytes(texts[i][depth : depth + 8].ljust(8, b"\0"), "big") for i in rows], np.uint64)


def deep_shallow(texts: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of texts and the length of the common prefix of each with the one before."""
    order: list[int] = []
    shared: list[int] = []

    def place(rows: list[int], lengths: list[int]) -> None:
        if not rows:
            return
        lengths[0] = common_prefix(texts[order[-1]], texts[rows[0]]) if order else 0
        order.extend(rows)
        shared.extend(lengths)

    stack = [(np.arange(len(texts)), 0)]
    while stack:
        rows, depth = stack.pop()
        if len(rows) <= 1 or depth >= shallow:
            if len(rows):
                trie = BlindTrie(texts, int(rows[0]))
                for i in rows[1:].tolist():
                    trie.add(i)
                place(*trie.ordered())
            continue
        keys = _super(texts, rows, depth)
        pivot = np.partition(keys, len(keys) // 2)[len(keys) // 2]
        # The three parts of multikey quicksort; only the middle one goes deeper.
        same = keys == pivot
        for part, down in ((rows[keys > pivot], depth), (rows[same], depth + 8), (rows[keys < pivot], depth)):
            if len(part):
                stack.append((part, down))
    return np.array(order, np.int64), np.array(shared, np.int64)


def repeated_starts(
    befores: list[bytes], afters: list[bytes], weights: np.ndarray, firsts: np.ndarray, lasts: np.ndarray,
    anchors: np.ndarray, length: int,
) -> list[np.ndarray]:
    """Starts of the windows of each context that a context elsewhere shares (weights count copies)."""
    n = len(afters)
    after_order, after_shared = deep_shallow(afters)
    before_order, before_shared = deep_shallow([b[::-1] for b in befores])
    hits: list[list[int]] = [[] for _ in range(n)]
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    least, most = anchors - lasts, anchors - firsts
    for offset in range(int(least.min()), int(most.max()) + 1):
        right[after_order] = np.cumsum(after_shared < length - offset)
        left[before_order] = np.cumsum(before_shared < offset)
        live = np.flatnonzero((least <= offset) & (offset <= most))
        if len(live) < 2:
            continue
        codes, back = np.unique(right[live] * (n + 1) + left[live], return_inverse=True)
        copies = np.bincount(back, weights=weights[live], minlength=len(codes))
        for i in live[(copies[back] > 1) & (weights[live] == 1)].tolist():
            hits[i].append(int(anchors[i]) - offset)
    return [np.array(h[::-1], np.int64) for h in hits]


def _contexts(length: int):
    """The bytes around the anchor of each wanted block of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, piece in slices(batch.column("__text")):
                for i, text in enumerate(piece):
                    rows = batch.column("wanted")[start + i].as_py()
                    key = batch.column("key").take(pa.array(np.full(len(rows), start + i)))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([r["gram"] for r in rows], pa.int64()), key,
                        *(pa.array([r[c] for r in rows], pa.int32()) for c in ("first", "last", "anchor")),
                        pa.array([r["n"] for r in rows], pa.int64()),
                        pa.array([text[r["first"] : r["last"] + length] for r in rows], pa.binary())],
                        ["gram", "key", "first", "last", "anchor", "n", "context"])

    return run


def _sort_cells(length: int):
    """Contexts in order of their gram: whole cells are gathered to about CELL_ROWS and sorted."""

    def flush(held: list[dict]) -> pa.RecordBatch:
        numbers = {c: np.array([r[c] for r in held], np.int64) for c in ("first", "last", "anchor", "n")}
        cut = numbers["anchor"] - numbers["first"]
        befores = [r["context"][:c] for r, c in zip(held, cut)]
        afters = [r["context"][c : c + length] for r, c in zip(held, cut)]
        starts = repeated_starts(
            befores, afters, numbers["n"], numbers["first"], numbers["last"], numbers["anchor"], length)
        keys, firsts, lasts = [], [], []
        for r, s in zip(held, starts):
            if len(s):
                edge = np.flatnonzero(np.diff(s) != 1)
                firsts.extend(s[np.concatenate([[0], edge + 1])].tolist())
                lasts.extend(s[np.concatenate([edge, [len(s) - 1]])].tolist())
                keys.extend([r["key"]] * (len(edge) + 1))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())],
            ["key", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= CELL_ROWS and held[-1]["gram"] != row["gram"]:
                    yield flush(held)
                    held = []
                held.append(row)
        if held:
            yield flush(held)

    return run


def _remove(keep: list[str], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ranges = [], range_arrays(batch.column("ranges"))
            for start, piece in slices(batch.column("__text")):
                for i, text in enumerate(piece):
                    gone = covered(*ranges[start + i], length, len(text))
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if gone.any() else text
                    spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                    rows.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            values = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *values],
                                             [*keep, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, keep: list[str], length: int = 400, text: str = "text") -> DataFrame:
    """Columns `keep` of docs with n_bytes, n_removed, n_spans and kept_sha256."""
    scratch = Scratch(docs.sparkSession)
    scheme = Scheme("bytes", length, min(GRAM, length))
    rows = prepared(docs, keep, text)
    found = find_blocks(rows, keep, scheme, scratch)
    small, large = found.parts.filter(F.col("group") <= CELL_ROWS), found.parts.filter(F.col("group") > CELL_ROWS)
    contexts = texts_of(found.candidates, small).mapInArrow(
        _contexts(length),
        "gram bigint, key binary, first int, last int, anchor int, n bigint, context binary")
    parts = "key binary, first int, last int"
    cells = contexts.repartition("gram").sortWithinPartitions("gram")
    single = cells.mapInArrow(_sort_cells(length), parts)
    if not large.isEmpty():
        single = single.unionByName(windows_in_parts(found.candidates, large, scheme, scratch))
    ranges = scratch.store(ranges_of(found.whole, single))
    joined = found.candidates.select(*keep, "key", "__text").join(ranges, "key", "left")
    fields = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)
    schema = f"{fields}n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    touched = joined.mapInArrow(_remove(keep, length), schema)
    bare = rows.select(
        *keep, F.xxhash64("__text").alias("k"), F.octet_length("__text").cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"),
        F.sha2("__text", 256).alias("kept_sha256"))
    return touched.unionByName(bare.join(found.repeated_keys, "k", "left_anti").drop("k"))

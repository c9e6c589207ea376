"""Where sequences of `length` units (words or bytes) occur more than once, without listing all of them.

Every window of `length` units has an anchor: its gram of `gram` units with the least hash, the rightmost of
equal ones. The anchor depends on the content of the window alone, so equal windows have equal anchors at
equal offsets. Consecutive windows of a text with the same anchor form a block; there are about
2 / (length - gram) blocks per unit.

1. Blocks whose anchor gram occurs once in the corpus can't repeat and are dropped.
2. Blocks with equal content (128-bit hash) repeat as a whole; one aggregation decides them.
3. Blocks that stand alone but share their gram with others may repeat in part. Their single windows are
   compared with those of one example of each block of the gram, weighted with its number of copies.

Everything is counted by partial aggregation, so a passage that stands in a third of all documents is no
problem, and no pairs are formed. Texts are shuffled once; those without repeated grams go no further.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, text_or_empty

#: Units handled at once; positions fit into the low bits of a hash.
CHUNK = 1 << 18
_POSITION = np.uint64((1 << 21) - 1)
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


@dataclass(frozen=True)
class Scheme:
    kind: str  # "words" or "bytes"
    length: int
    gram: int


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits."""
    x = (x ^ (x >> np.uint64(33))) * _MIX[0]
    x = (x ^ (x >> np.uint64(29))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


@lru_cache(maxsize=1)
def _byte_units() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[0]))


class Speller:
    """Units of texts as 64-bit values; remembers words."""

    def __init__(self, scheme: Scheme):
        self.scheme, self.known = scheme, {}

    def units(self, text: bytes) -> np.ndarray:
        if self.scheme.kind == "bytes":
            return _byte_units()[np.frombuffer(text, np.uint8)]
        words, known = text.split(), self.known
        if len(known) > 500_000:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w, 7)
        return np.fromiter((known[w] for w in words), np.uint64, len(words))


class Spans:
    """Hashes of any span of one array of units, from prefix sums in two lanes."""

    def __init__(self, units: np.ndarray):
        self.sums, self.inverse = [], []
        for lane, base in enumerate(_BASES):
            power, inverse = _powers(base, 2 * CHUNK)
            values = units if lane == 0 else mix(units ^ np.uint64(base))
            sums = np.zeros(len(units) + 1, np.uint64)
            np.cumsum(values * power[: len(units)], out=sums[1:])
            self.sums.append(sums)
            self.inverse.append(inverse)

    def lane(self, lane: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        sums = self.sums[lane]
        return mix((sums[stop] - sums[start]) * self.inverse[lane][start] + (stop - start).astype(np.uint64))


def chunks(texts: list[bytes], speller: Speller) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(units, text of each unit, position of each unit in its text, end in units of the text's part).

    Texts share a chunk of at most CHUNK units; a longer text is cut into parts that overlap by a window.
    """
    overlap = speller.scheme.length - 1
    batch: list[tuple[np.ndarray, int, int]] = []
    size = 0

    def flush():
        units = np.concatenate([u for u, _, _ in batch])
        lengths = [len(u) for u, _, _ in batch]
        owner = np.repeat([t for _, t, _ in batch], lengths)
        ends = np.repeat(np.cumsum(lengths), lengths)
        shift = np.repeat([p for _, _, p in batch] - (np.cumsum(lengths) - lengths), lengths)
        return units, owner, shift + np.arange(len(units)), ends

    for t, text in enumerate(texts):
        units = speller.units(text)
        if len(units) < speller.scheme.length:
            continue
        for start in range(0, len(units) - overlap, CHUNK - overlap):
            part = units[start : start + CHUNK]
            if batch and size + len(part) > CHUNK:
                yield flush()
                batch, size = [], 0
            batch.append((part, t, start))
            size += len(part)
    if batch:
        yield flush()


@dataclass
class Found:
    """Blocks of one chunk: arrays of text, first and last window start, anchor position, gram hash."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray
    base: np.ndarray  # index in the chunk of the text's unit 0
    spans: Spans


def blocks(units: np.ndarray, owner: np.ndarray, position: np.ndarray, ends: np.ndarray, scheme: Scheme) -> Found:
    spans = Spans(units)
    n, width = len(units), scheme.length - scheme.gram + 1
    at = np.arange(n - scheme.gram + 1)
    gram = spans.lane(0, at, at + scheme.gram)
    least = (gram & ~_POSITION) | (_POSITION - at.astype(np.uint64))
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    anchor = (_POSITION - (least & _POSITION)).astype(np.int64)
    starts = np.flatnonzero(np.arange(len(anchor)) + scheme.length <= ends[: len(anchor)])
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Found(none, none, none, none, none.astype(np.uint64), none, spans)
    chosen = anchor[starts]
    new = np.concatenate([[True], (np.diff(chosen) != 0) | (np.diff(starts) != 1)])
    first = starts[new]
    last = starts[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]
    shift = position[first] - first
    return Found(owner[first], first + shift, last + shift, chosen[new] + shift, gram[chosen[new]], -shift, spans)


def _grams(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(scheme)
        for batch in batches:
            keys = batch.column("k").to_numpy(zero_copy_only=False)
            for start, piece in slices(batch.column("__text")):
                for chunk in chunks(piece, speller):
                    found = blocks(*chunk, scheme)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[start + found.text]), pa.array(found.gram.view(np.int64))], ["k", "gram"])

    return run


_BLOCK = "gram bigint, hi bigint, lo bigint, key binary, first int, last int, anchor int"


def _candidates(scheme: Scheme):
    """Blocks of candidate texts whose gram is repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(scheme)
        for batch in batches:
            grams = batch.column("grams")
            for start, piece in slices(batch.column("__text")):
                wanted = [np.sort(grams[start + i].values.to_numpy(zero_copy_only=False)) for i in range(len(piece))]
                for chunk in chunks(piece, speller):
                    f = blocks(*chunk, scheme)
                    signed = f.gram.view(np.int64)
                    keep = np.zeros(len(signed), bool)
                    edges = np.flatnonzero(np.diff(f.text, prepend=-1, append=-1))
                    for i, j in zip(edges[:-1], edges[1:]):
                        own = wanted[f.text[i]]
                        slot = np.minimum(np.searchsorted(own, signed[i:j]), len(own) - 1)
                        keep[i:j] = own[slot] == signed[i:j]
                    a, b = (f.first + f.base)[keep], (f.last + f.base)[keep] + scheme.length
                    yield pa.RecordBatch.from_arrays([
                        pa.array(signed[keep]), pa.array(f.spans.lane(0, a, b).view(np.int64)),
                        pa.array(f.spans.lane(1, a, b).view(np.int64)),
                        batch.column("key").take(pa.array(start + f.text[keep])),
                        pa.array(f.first[keep], pa.int32()), pa.array(f.last[keep], pa.int32()),
                        pa.array(f.anchor[keep], pa.int32())], ["gram", "hi", "lo", "key", "first", "last", "anchor"])

    return run


def _single_windows(scheme: Scheme):
    """Hashes of the windows of the wanted blocks of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(scheme)
        for batch in batches:
            wanted = range_arrays(batch.column("wanted"), "n")
            for start, piece in slices(batch.column("__text")):
                for i, text in enumerate(piece):
                    units = speller.units(text)
                    first, last, n = wanted[start + i]
                    for at, weight, base in _starts(first, last, n):
                        spans = Spans(units[base : int(at[-1]) + scheme.length])
                        own = at - base
                        key = batch.column("key").take(pa.array(np.full(len(at), start + i)))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(spans.lane(0, own, own + scheme.length).view(np.int64)),
                            pa.array(spans.lane(1, own, own + scheme.length).view(np.int64)),
                            pa.array(weight, pa.int64()), key, pa.array(at, pa.int32())],
                            ["hi", "lo", "n", "key", "first"])

    return run


def _starts(first: np.ndarray, last: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Window starts of blocks in order, their weights, and the least start, for spans below CHUNK units."""
    order = np.argsort(first, kind="stable")
    first, last, n = first[order], last[order], n[order]
    low = 0
    while low < len(first):
        high = int(np.searchsorted(first, first[low] + CHUNK // 2))
        count = last[low:high] - first[low:high] + 1
        at = np.repeat(first[low:high] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        at, weight = at.astype(np.int64), np.repeat(n[low:high], count)
        order = np.argsort(at, kind="stable")
        yield at[order], weight[order], int(first[low])
        low = high


def range_arrays(column: pa.ListArray, *more: str) -> list[tuple[np.ndarray, ...]]:
    """first, last (and further fields) of a column of lists of structs, as arrays for each row; null is empty."""
    flat = column.flatten()
    fields = [flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "last", *more)]
    counts = np.array([len(x) if x.is_valid else 0 for x in column], np.int64)
    ends = np.cumsum(counts)
    return [tuple(f[e - c : e] for f in fields) for e, c in zip(ends, counts)]


@dataclass
class Recurrence:
    """candidates: rows of docs that may hold repeats (keep, key, __text). rest: `keep` columns and k of all
    rows with `candidate` false. whole: key, first, last of repeated blocks. parts: examples to be compared in
    part: gram, n (copies), key, first, last, anchor, group (distinct blocks of the gram)."""

    candidates: DataFrame
    repeated_keys: DataFrame
    whole: DataFrame
    parts: DataFrame


def find_blocks(docs: DataFrame, keep: list[str], scheme: Scheme, scratch: Scratch) -> Recurrence:
    """docs: `keep` columns and __text (no nulls)."""
    # k only proposes candidates; a collision of two texts costs time but changes no result.
    keyed = docs.withColumn("k", F.xxhash64("__text"))
    grams = scratch.store(keyed.select("k", "__text").mapInArrow(_grams(scheme), "k bigint, gram bigint"))
    # Stored, so that the join below reads both sides from a shuffle and can split a hot gram.
    often = scratch.store(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"))
    held = grams.join(often, "gram", "left_semi").groupBy("k").agg(F.collect_set("gram").alias("grams"))
    held = scratch.store(held)
    scratch.drop(grams)
    keys = held.select("k")
    candidates = scratch.store(keyed.join(held, "k").withColumn("key", F.unhex(F.md5("__text"))).drop("k"))
    found = scratch.store(candidates.select("key", "grams", "__text").mapInArrow(_candidates(scheme), _BLOCK))
    same = ["gram", "hi", "lo"]
    distinct = scratch.store(found.groupBy(*same).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "first", "last", "anchor")).alias("example")))
    whole = found.join(distinct.filter("n > 1").select(*same), same, "left_semi").select("key", "first", "last")
    groups = distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("group")).filter("group > 1")
    parts = distinct.join(groups, "gram").select("gram", "n", "example.*", "group")
    return Recurrence(candidates, keys, whole.distinct(), scratch.store(parts))


def texts_of(candidates: DataFrame, parts: DataFrame) -> DataFrame:
    """key, __text, wanted: each candidate text once, with the examples that were chosen from it."""
    wanted = parts.groupBy("key").agg(F.collect_list(F.struct("first", "last", "anchor", "n", "gram")).alias("wanted"))
    return candidates.select("key", "__text").dropDuplicates(["key"]).join(wanted, "key")


def windows_in_parts(candidates: DataFrame, parts: DataFrame, scheme: Scheme, scratch: Scratch) -> DataFrame:
    """key, first, last (= first) of the windows of lone examples that another example shares."""
    rows = scratch.store(texts_of(candidates, parts).mapInArrow(
        _single_windows(scheme), "hi bigint, lo bigint, n bigint, key binary, first int"))
    often = scratch.store(
        rows.groupBy("hi", "lo").agg(F.sum("n").alias("copies")).filter("copies > 1").select("hi", "lo"))
    lone = rows.filter("n = 1").join(often, ["hi", "lo"], "left_semi")
    return lone.select("key", "first", F.col("first").alias("last"))


def ranges_of(whole: DataFrame, parts: DataFrame) -> DataFrame:
    """key, ranges: the repeated windows of each text as arrays of first and last start."""
    return whole.unionByName(parts).groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def runs_of(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive window starts."""
    if not len(first):
        return first, last
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > reach[:-1] + 1])
    return first[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(first) - 1]])]


def covered(first: np.ndarray, last: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of `size` units the windows that start in the ranges cover."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, np.minimum(size, last + length), -1)
    return np.cumsum(edges)[:size] > 0


def prepared(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    return docs.select(*keep, text_or_empty(text).alias("__text"))

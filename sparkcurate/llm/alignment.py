"""Alignment of two tokenizers over the same bytes by interval coalescing.

Both token sequences of a text cover the bytes of space + text. All A and B tokens are sorted by start (A first);
the running maximum of their ends (`maximum.accumulate`) breaks them into groups wherever a start reaches it, so a
group is the shortest stretch after which tokens of both end together. Inside a group each A token is expanded to
the B tokens whose byte range overlaps its own; these are the links. A link's count is the number of links of the
whole corpus that hold the same pair of ids.

Scale: texts are encoded in slices of a few megabytes; equal texts of a slice once. A slice lists its different id
pairs with their frequencies, and a document refers to the pairs of its slice by number, so what is shuffled is
one row per slice and pair, not one per link. Totals per pair combine map-side, the best pair of a B id is one row
per vocabulary entry (broadcast: bounded by the vocabulary), and counts return to the slices by a join on the pair.
A task then holds one slice of documents and its pairs; no group is larger than SLICE_BYTES or one text.
Texts are cut before single spaces between characters that are no white space, where both tokenizers end a token
(neither vocabulary has a space after another character, and pre-tokens begin there). So a group never crosses
a cut, the different pieces of a slice are encoded and aligned once, and a document joins what its pieces have.

Edge cases: texts null, empty, or whose joined token bytes differ from space + text have no tokens: all numbers 0
and an empty `groups_sha256`. Repeated rows are counted and returned each; ties at the top are all best; extra
columns play no part; empty tables give empty results.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices

#: Text handed to a tokenizer at once.
BATCH_BYTES = 1 << 18
CUT = re.compile(r"(?<=\S) (?=\S)")


# --------------------------------------------------------------------------
# tokenizers


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others as U+0100 and up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level BPE file of the tokenizers library; special strings in texts are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.no_truncation()
        self.model.no_padding()
        alphabet = byte_alphabet()
        entries = self.model.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.pieces[number] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self.model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in found]


class SentencePieces:
    """A sentencepiece file, which puts the leading space itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.pieces = [self._bytes(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())]

    @staticmethod
    def _bytes(piece: str) -> bytes:
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Side:
    """One tokenizer with what the alignment needs of its vocabulary; kept for the life of a Python worker."""

    def __init__(self, path: str):
        self.coder = ByteLevel(path) if path.endswith(".json") else SentencePieces(path)
        self.lengths = np.array([len(p) for p in self.coder.pieces], np.int64)
        #: Each id followed by nothing, a comma, a bar and a semicolon.
        self.written = [f"{i}{end}" for i in range(len(self.coder.pieces)) for end in ("", ",", "|", ";")]

    def encode(self, texts: list[str]) -> list[list[int]]:
        # A library's own result takes some hundred bytes a token, so it is held for one batch only.
        out = []
        for first, stop in batches_of([len(t) for t in texts]):
            out += self.coder.encode(texts[first:stop])
        return out

    def covers(self, ids: list[int], text: str) -> bool:
        """Whether the joined bytes of the tokens are space + text."""
        pieces = self.coder.pieces
        return b"".join([pieces[i] for i in ids]) == b" " + text.encode("utf-8", "surrogatepass")


def batches_of(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of items of about BATCH_BYTES together."""
    first, total = 0, 0
    for i, size in enumerate(sizes, 1):
        total += size
        if total >= BATCH_BYTES or i == len(sizes):
            yield first, i
            first, total = i, 0


@lru_cache(maxsize=4)
def load_side(path: str) -> Side:
    return Side(path)


# --------------------------------------------------------------------------
# one text


def coalesce(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number of each A and each B token, for tokens that cover the same bytes without gaps."""
    ends = np.concatenate((a_ends, b_ends))
    starts = np.concatenate(([0], a_ends[:-1], [0], b_ends[:-1]))
    side = np.repeat([0, 1], (len(a_ends), len(b_ends)))
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[: len(a_ends)], group[len(a_ends) :]


def expand(a_ends: np.ndarray, b_ends: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs of an A and a B token with overlapping bytes; partners lie in one group."""
    a_starts = np.concatenate(([0], a_ends[:-1]))
    b_starts = np.concatenate(([0], b_ends[:-1]))
    # All pairs of each group, then those that overlap: groups are a few tokens.
    sizes = np.bincount(b_group)
    first = np.cumsum(sizes) - sizes
    times = sizes[a_group]
    left = np.repeat(np.arange(len(a_ends)), times)
    skip = np.repeat(np.cumsum(times) - times, times)
    right = first[a_group[left]] + np.arange(len(left)) - skip
    overlap = (a_starts[left] < b_ends[right]) & (b_starts[right] < a_ends[left])
    return left[overlap], right[overlap]


def written_tokens(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, last: np.ndarray,
                   sides: tuple[Side, Side]) -> list[str]:
    """The ids in order of group and side, each with what follows it in `a1,a2|b1;a3|b2,b3`; nothing after groups in `last`."""
    group = np.concatenate((a_group, b_group))
    side = np.repeat([0, 1], (len(a), len(b)))
    order = np.lexsort((side, group))
    group, side = group[order], side[order]
    # A comma in a list, a bar before B, a semicolon before the next group.
    end = np.full(len(order), 3)
    end[:-1] = np.where(group[1:] > group[:-1], 3, np.where(side[1:] > side[:-1], 2, 1))
    end[(end == 3) & last[group]] = 0
    index = np.concatenate((a, b))[order] * 4 + end
    first, second = (s.written for s in sides)
    return [second[i] if s else first[i] for i, s in zip(index.tolist(), side.tolist())]


@dataclass
class Pieces:
    """What the different pieces of a slice have: numbers per piece, the written groups, and the links of all in a row."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    written: list[str]
    links: np.ndarray
    n_links: np.ndarray


def align_pieces(texts: list[str], sides: tuple[Side, Side]) -> Pieces:
    """Align all pieces at once: laid one after another, both token sequences still end together at each piece."""
    found = [s.encode(texts) for s in sides]
    good = np.array([sides[0].covers(a, t) and sides[1].covers(b, t) for a, b, t in zip(*found, texts)], bool)
    counts = [np.array([len(x) if g else 0 for x, g in zip(f, good)], np.int64) for f in found]
    a, b = (np.array([i for x, g in zip(f, good) if g for i in x], np.int64) for f in found)
    if not len(a):
        none = np.zeros(len(texts), np.int64)
        return Pieces(good, none, none, none, [""] * len(texts), np.zeros(0, np.int64), none)
    a_ends, b_ends = np.cumsum(sides[0].lengths[a]), np.cumsum(sides[1].lengths[b])
    a_group, b_group = coalesce(a_ends, b_ends)
    owner = np.repeat(np.arange(len(texts)), counts[0])
    piece_of_group = np.empty(a_group[-1] + 1, np.int64)
    piece_of_group[a_group] = owner
    last = np.append(piece_of_group[1:] != piece_of_group[:-1], True)
    tokens = written_tokens(a, b, a_group, b_group, last, sides)
    edges = np.cumsum(counts[0] + counts[1]).tolist()
    written = ["".join(tokens[low:high]) for low, high in zip([0, *edges[:-1]], edges)]
    left, right = expand(a_ends, b_ends, a_group, b_group)
    return Pieces(good, *counts, np.bincount(piece_of_group, minlength=len(texts)), written,
                  a[left] * len(sides[1].lengths) + b[right], np.bincount(owner[left], minlength=len(texts)))


def align(texts: list[str], sides: tuple[Side, Side]) -> tuple[list[tuple[int, int, int, str, np.ndarray]], np.ndarray, np.ndarray]:
    """Of each text: n_a, n_b, n_groups, groups_sha256 and its links as places in the second result.

    The second result lists the linked pairs of all texts as a * (size of B) + b, the third how often each is linked.
    """
    number: dict[str, int] = {}
    cut = [np.array([number.setdefault(p, len(number)) for p in CUT.split(t)], np.int64) if t else None for t in texts]
    have = align_pieces(list(number), sides)
    pairs, place = np.unique(have.links, return_inverse=True)
    start = np.cumsum(have.n_links) - have.n_links
    out, times = [], np.zeros(len(pairs), np.int64)
    for at in cut:
        if at is None or not have.good[at].all():
            out.append((0, 0, 0, "", np.zeros(0, np.int32)))
            continue
        n = have.n_links[at]
        links = place[np.arange(n.sum()) + np.repeat(start[at] - np.cumsum(n) + n, n)].astype(np.int32)
        times += np.bincount(links, minlength=len(pairs))
        told = ";".join([have.written[i] for i in at.tolist()])
        out.append((int(have.n_a[at].sum()), int(have.n_b[at].sum()), int(have.n_groups[at].sum()), sha256(told.encode()).hexdigest(), links))
    # Pairs that only texts without tokens would have are not listed.
    used = np.flatnonzero(times)
    if len(used) < len(pairs):
        new = np.cumsum(times > 0) - 1
        out = [(*row[:4], new[row[4]].astype(np.int32)) for row in out]
    return out, pairs[used], times[used]


# --------------------------------------------------------------------------
# the corpus

FACTS = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "groups_sha256": pa.string(),
         "links": pa.list_(pa.int32()), "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int64())}
FACTS_SCHEMA = ("n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<int>, pairs array<bigint>, "
                "times array<bigint>, slice binary")


def _aligner(paths: tuple[str, str], keep: list[str]):
    """Rows of a slice; the first carries the pairs of the slice with their frequencies, `links` are places in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = tuple(load_side(p) for p in paths)
        for batch in batches:
            for start, texts in slices(batch.column("__text")):
                rows, pairs, times = align([t.decode("utf-8", "surrogatepass") for t in texts], sides)
                links = [r[4] for r in rows]
                once = [None] * (len(rows) - 1)
                facts = [*([r[i] for r in rows] for i in range(4)), links, [pairs, *once], [times, *once]]
                kept = [batch.column(c).slice(start, len(rows)) for c in keep]
                # The rows of a slice and its pairs are written by one task, so any name of its own will do.
                name = os.urandom(16)
                yield pa.RecordBatch.from_arrays(
                    [*kept, *(pa.array(f, t) for f, t in zip(facts, FACTS.values())), pa.array([name] * len(rows), pa.binary())],
                    [*keep, *FACTS, "slice"])

    return run


def _sums(documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """Of each document of one slice: links that are best of their B id, and the counts of all its links."""
    order = np.argsort(pairs.column("place").to_numpy())
    count = pairs.column("count").to_numpy()[order]
    best = pairs.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    n_links, n_best, count_sum = [], [], []
    for links in documents.column("links"):
        at = links.values.to_numpy() if len(links) else np.zeros(0, np.int32)
        n_links.append(len(at))
        n_best.append(int(best[at].sum()))
        count_sum.append(int(count[at].sum()))
    kept = [c for c in documents.column_names if c not in ("links", "slice")]
    out = documents.select(kept)
    for name, values in (("n_links", n_links), ("n_best", n_best), ("count_sum", count_sum)):
        out = out.append_column(name, pa.array(values, pa.int64()))
    return out


def align_documents(docs: DataFrame, path_a: str, path_b: str, keep: list[str], text: str = "text") -> DataFrame:
    """One row per row of docs: `keep`, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    scratch = Scratch(docs.sparkSession)
    names = {c: f"__keep{i}" for i, c in enumerate(keep)}
    part = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()), F.col(f"`{text}`").cast("string").alias("__text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in part.schema.fields[:-1])
    rows = scratch.store(part.mapInArrow(_aligner((path_a, path_b), list(names.values())), f"{schema}, {FACTS_SCHEMA}"))
    width = len(load_side(path_b).lengths)

    listed = rows.filter("pairs IS NOT NULL").select(
        F.col("slice").alias("owner"), F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "p")).select(
        "owner", "place", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = scratch.store(listed.groupBy("pair").agg(F.sum("times").alias("count")))
    b_of = F.pmod("pair", F.lit(width)).cast("int").alias("b")
    # At most one row per entry of B.
    top = scratch.store(counts.groupBy(b_of).agg(F.max("count").alias("top")))
    scored = counts.withColumn("b", b_of).join(F.broadcast(top), "b").select(
        "pair", "count", (F.col("count") == F.col("top")).alias("best"))
    told = listed.join(scratch.store(scored), "pair").select("owner", "place", "count", "best")
    facts = rows.select(*names.values(), "n_a", "n_b", "n_groups", "groups_sha256", "links", "slice")
    out = facts.groupBy("slice").cogroup(told.groupBy("owner")).applyInArrow(
        _sums, f"{schema}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_links bigint, n_best bigint, count_sum bigint")
    return out.select(*(F.col(n).alias(c) for c, n in names.items()), "n_a", "n_b", "n_groups", "n_links", "n_best",
                      "count_sum", "groups_sha256")

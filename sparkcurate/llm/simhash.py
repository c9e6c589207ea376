"""SimHash near-duplicates by pigeonhole blocks.

A text gets a 64-bit fingerprint: bit i is 1 if more than half of the XXH64 values (seed 42) of its word
shingles, repeats included, have it. Fingerprints that differ in at most `bits` bits are linked. The 64
bits are cut into bits + 4 blocks; a linked pair differs in at most `bits` of them, so it agrees on some
4 blocks. There is one key for every choice of 4 blocks; rows are joined on it and the Hamming distance is
verified. For 2 bits that is 15 keys of about 42 bits, so unrelated fingerprints hardly meet.

Scale: copies collapse to one row per fingerprint first. A bucket of more than `bucket_rows` fingerprints
is not joined with itself. Its members are tied exactly and linearly: two values at distance 2 or less
have a common value at distance 1 or less from both, so each member is keyed by itself and by its
one-bit neighbours, and all members of such a key are linked to the least of them. This covers 2 bits;
for 2r bits the neighbours are those at r bits. No link is lost.

Edge cases: null and blank texts have the fingerprint 0 and are linked like any other; texts below the
shingle length hash as one sequence; repeated rows share a class; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import small_side
from .common import Scratch, slices, spare_name, text_or_empty
from .components import components
from .recurrence import Scheme, Speller, mix

BUCKET_ROWS = 32
SPARE_BLOCKS = 4
#: Texts in which common shingles are looked for, and how many of those are kept; both change only the work.
SAMPLE = 1 << 15
COMMON = 1 << 16
#: Shingles of full blocks that each new order of the shingles learns; it changes only the work, too.
LEARNED = 1 << 18
#: Turns of the hubs that full blocks are compared with first, and parts of the shingle values in which shared ones are counted.
HUBS = 4
PARTS = 16
#: Bytes of shingle sets that one task compares at a time.
SLICE_OF_SETS = 32 << 20
#: The same for the parities of sets.
SLICE_OF_PARITIES = 1 << 19
SHINGLE_BASE = 0x9E3779B97F4A7C15
# Hashes counted at once: eight bytes become 64 counters.
CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The SimHash of one text; A-Z are folded, other letters stay as they are."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        stop = min(n, start + CHUNK)
        hashes = np.fromiter(
            (digest(b" ".join(words[i : i + shingle]), 42) for i in range(start, stop)), np.uint64, stop - start)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def majority(hashes: np.ndarray) -> int:
    """The SimHash of values that are hashes already."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(keep: list[str], shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, shingle) for _, piece in slices(batch.column("__text")) for t in piece]
            signed = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(signed)], [*keep, "__fp"])

    return run


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 3, text: str = "text") -> DataFrame:
    """Columns `keep` of docs and `__fp`, the fingerprint as a signed long."""
    part = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in part.schema.fields[:-1])
    return part.mapInArrow(_fingerprints(keep, shingle), f"{schema}, __fp bigint")


def block_masks(bits: int, spare: int = SPARE_BLOCKS) -> list[int]:
    """Signed masks of the choices of `spare` blocks out of bits + spare."""
    blocks = bits + spare
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    out = []
    for chosen in combinations(masks, spare):
        mask = sum(chosen)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def close_links(values: DataFrame, bits: int, scratch: Scratch, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """values: distinct `fp`. Links a, b whose closure joins exactly the fingerprints at <= bits bits."""
    keys = F.array(*(
        F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(block_masks(bits))))
    keyed = scratch.store(values.select("fp", F.explode(keys).alias("k")).select("k.table", "k.key", "fp"))
    sizes = scratch.store(keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    placed = scratch.store(keyed.join(sizes, ["table", "key"]))
    few = placed.filter(F.col("n") <= bucket_rows)
    left = few.select("table", "key", F.col("fp").alias("a"))
    right = few.select("table", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    pairs = left.join(right, ["table", "key"]).filter((F.col("a") < F.col("b")) & near).select("a", "b")
    hot = placed.filter(F.col("n") > bucket_rows).select("fp").distinct()
    return pairs.distinct().unionByName(_hot_links(hot, bits))


def _hot_links(hot: DataFrame, bits: int) -> DataFrame:
    """Fingerprints of full buckets, tied through common neighbours: 2r bits apart means r from some value."""
    if bits % 2:
        raise ValueError("full buckets are linked for an even number of bits")
    flips = [0]
    for r in range(1, bits // 2 + 1):
        flips += [sum(1 << i for i in chosen) for chosen in combinations(range(64), r)]
    signed = F.array(*(F.lit(f - (1 << 64) if f >> 63 else f) for f in flips))
    spread = hot.select("fp", F.explode(F.transform(signed, lambda f: f.bitwiseXOR(F.col("fp")))).alias("via"))
    least = spread.groupBy("via").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return spread.join(least, "via").filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", shingle: int = 3, bits: int = 2, text: str = "text"
) -> DataFrame:
    """One row per row of docs: id_column, fingerprint (16 hex digits), component_id (least id of the class)."""
    scratch = Scratch(docs.sparkSession)
    printed = scratch.store(fingerprints(docs.select(F.col(id_column).alias("__id"), text), ["__id"], shingle, text))
    values = scratch.store(printed.groupBy(F.col("__fp").alias("fp")).agg(F.min("__id").alias("least")))
    classes = components(close_links(values.select("fp"), bits, scratch), scratch)
    rooted = values.join(classes.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = scratch.store(rooted.select("fp", "least", F.coalesce("root", "fp").alias("root")))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select(F.col("fp").alias("__fp"), "component_id")
    hexed = F.lower(F.lpad(F.hex("__fp"), 16, "0"))
    return printed.join(named, "__fp").select(F.col("__id").alias(id_column), hexed.alias("fingerprint"), "component_id")


# --------------------------------------------------------------------------
# texts that share most of their shingles


def shingle_set(units: np.ndarray, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit values of the word shingles (fewer words: the whole sequence; none: one value)."""
    width = min(shingle, len(units))
    total = np.zeros(max(1, len(units) - width + 1), np.uint64)
    for j in range(width):
        total += units[j : j + len(total)] * np.uint64(pow(SHINGLE_BASE, j + 1, 1 << 64))
    return np.unique(mix(total))


def _sets_of(piece: list[bytes], speller: Speller, shingle: int) -> list[np.ndarray]:
    return [shingle_set(speller.units(t.lower()), shingle) for t in piece]


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Keys and texts of the slices of a task, without texts that it had before (as far as it remembers)."""
    seen: set[bytes] = set()
    for batch in batches:
        keys = batch.column("key").to_pylist()
        for start, piece in slices(batch.column("__text")):
            if len(seen) > 1_000_000:
                seen.clear()
            fresh = {k: t for k, t in zip(keys[start:], piece) if k not in seen}
            seen.update(fresh)
            if fresh:
                yield list(fresh), list(fresh.values())


def _sampled_shingles(shingle: int):
    """Shingles of each slice with the number of its texts that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(Scheme("words", shingle, 0))
        for _, piece in _different(batches):
            found, n = np.unique(np.concatenate(_sets_of(piece, speller, shingle)), return_counts=True)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["shingle", "n"])

    return run


def common_shingles(rows: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of four or more of SAMPLE texts, the most common last, at most COMMON of them; and in how many texts they are.

    They only say which shingles a prefix takes last. Any order that is the same for all texts gives the same
    links, so the sample and the limit change the work and never the result.
    """
    share = min(1.0, SAMPLE / max(1, rows.count()))
    chosen = rows.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(share * (1 << 20)))
    counts = chosen.select("key", "__text").mapInArrow(_sampled_shingles(shingle), "shingle bigint, n bigint")
    top = counts.groupBy("shingle").agg(F.sum("n").alias("n")).filter("n >= 4").orderBy(F.desc("n"), "shingle").limit(COMMON)
    found = top.collect()[::-1]
    return np.array([r.shingle for r in found], np.int64).view(np.uint64), np.array([r.n / share for r in found])


def with_full_blocks(known: tuple[np.ndarray, np.ndarray], full: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The common shingles with the LEARNED fullest blocks among them, the most common last. full: block, n."""
    told = full.select("block", "n").orderBy(F.desc("n"), "block").limit(LEARNED).toArrow()
    values = np.concatenate([known[0], told.column("block").to_numpy().astype(np.int64).view(np.uint64)])
    values, back = np.unique(values, return_inverse=True)
    most = np.zeros(len(values))
    np.maximum.at(most, back, np.concatenate([known[1], told.column("n").to_numpy()]))
    order = np.argsort(most, kind="stable")
    return values[order], most[order]


def prefix_of(found: np.ndarray, similarity: float, values: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The first shingles of a set, rare ones first: as many as it can't lose to a text of that similarity, and one.

    `values` are the common shingles, sorted, and `ranks` their places in the order.
    """
    size = len(found) - int(np.ceil(similarity * len(found) - 1e-6)) + 1
    at = np.searchsorted(values, found)
    at[at == len(values)] = 0
    rank = np.where(values[at] == found, ranks[at], -1) if len(values) else np.full(len(found), -1)
    return found[np.argsort(rank, kind="stable")[:size]]


def parity_of(found: np.ndarray) -> bytes:
    """One bit for every place modulo a power of two (a shingle a bit or more): whether an odd number of shingles is there."""
    bits = max(64, 1 << (len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def most_shared(size_a: int, parity_a: bytes, size_b: int, parity_b: bytes) -> float:
    """No fewer shingles than two sets share: each odd place of their difference holds one that only one of them has."""
    a, b = sorted((np.frombuffer(p, np.uint8) for p in (parity_a, parity_b)), key=len)
    odd = a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return (size_a + size_b - int(np.bitwise_count(odd).sum())) / 2


def _heads(shingle: int, similarity: float, common: np.ndarray):
    """Of each different text of a task: key, later (its prefix in the order that ends with the common shingles)."""
    order = np.argsort(common)
    values = common[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(Scheme("words", shingle, 0))
        for keys, piece in _different(batches):
            heads = [prefix_of(s, similarity, values, order).view(np.int64) for s in _sets_of(piece, speller, shingle)]
            ends = np.cumsum([0, *(len(h) for h in heads)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(heads)))],
                ["key", "later"])

    return run


def _prefixes(shingle: int, similarity: float, common: np.ndarray):
    """Of each different text of a task: key, size (shingles), fp (SimHash over the set), parity, heads (its prefix)."""
    order = np.argsort(common)
    values = common[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(Scheme("words", shingle, 0))
        for keys, piece in _different(batches):
            sets = _sets_of(piece, speller, shingle)
            heads = [prefix_of(s, similarity, values, order).view(np.int64) for s in sets]
            prints = np.array([majority(s) for s in sets], np.uint64).view(np.int64)
            ends = np.cumsum([0, *(len(h) for h in heads)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int32()), pa.array(prints),
                 pa.array([parity_of(s) for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(heads)))],
                ["key", "size", "fp", "parity", "heads"])

    return run


def _sets(shingle: int):
    """Of each different text of a task: key, shingles (its set as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(Scheme("words", shingle, 0))
        for keys, piece in _different(batches):
            sets = [s.tobytes() for s in _sets_of(piece, speller, shingle)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["key", "shingles"])

    return run


def _shingle_rows(shingle: int):
    """One row per different text of a task and shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(Scheme("words", shingle, 0))
        for keys, piece in _different(batches):
            for key, found in zip(keys, _sets_of(piece, speller, shingle)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(found), pa.binary()), pa.array(found.view(np.int64))], ["key", "shingle"])

    return run


def _similar(least: float):
    """Of the pairs of one slice: those whose sets, given beside them, reach the similarity."""

    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        known = {k: np.frombuffer(s, np.uint64) for k, s in zip(
            sets.column("id").to_pylist(), sets.column("shingles").to_pylist())}
        keep = []
        for left, right in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            a, b = known[left], known[right]
            at = np.searchsorted(a, b)
            both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
            keep.append(both >= least * (len(a) + len(b) - both) - 1e-9)
        return pairs.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _likely(least: float):
    """Of the pairs of one slice: those that can reach the similarity by the parities, given beside them."""

    def run(pairs: pa.Table, marks: pa.Table) -> pa.Table:
        known = dict(zip(marks.column("id").to_pylist(), zip(marks.column("size").to_pylist(), marks.column("parity").to_pylist())))
        keep = []
        for left, right in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            (size_a, a), (size_b, b) = known[left], known[right]
            keep.append(most_shared(size_a, a, size_b, b) * (1 + least) >= least * (size_a + size_b) - 1e-6)
        return pairs.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _ends(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).distinct()


def _cells(links: DataFrame, slices_: int) -> tuple[DataFrame, DataFrame]:
    """Links with their cell (`part`), one for each pair of slices of `a` and of `b`, and the ids that each cell needs."""
    slice_of = lambda c: F.pmod(F.xxhash64(c), F.lit(slices_))
    placed = links.select("a", "b", (slice_of("a") * slices_ + slice_of("b")).alias("part"))
    ends = placed.select("part", F.col("a").alias("id")).unionByName(placed.select("part", F.col("b").alias("id")))
    return placed, ends.distinct()


def likely_links(links: DataFrame, texts: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """The links (a, b) that can reach the similarity by the parities of their sets; none that reaches it is lost.

    A parity takes one to two bits for a shingle and a set 64, so most links by chance end here before a set moves.
    """
    marks = scratch.store(texts.select("id", "size", "parity").join(_ends(links), "id"))
    total = marks.agg(F.sum(F.octet_length("parity") + 64)).first()[0] or 0
    placed, wanted = _cells(links, max(1, -(-total // SLICE_OF_PARITIES)))
    near = marks.join(wanted, "id").select(F.col("part").alias("at"), "id", "size", "parity")
    found = scratch.store(placed.groupBy("part").cogroup(near.groupBy("at")).applyInArrow(_likely(similarity), "a bigint, b bigint"))
    scratch.drop(marks)
    return found


def verified(links: DataFrame, texts: DataFrame, rows: DataFrame, shingle: int, similarity: float, scratch: Scratch) -> DataFrame:
    """The links (a, b) whose texts reach the Jaccard similarity of their shingle sets.

    texts has id, key, size, parity of every different text, rows its text by key. Links that the parities leave meet the
    sets in cells, one for each pair of slices of `a` and of `b`. A cell gets each of its sets once, however many links
    name it, so a hub costs one set per cell and not one per link, and no cell holds more than two slices.
    """
    links = likely_links(links, texts, similarity, scratch)
    linked = scratch.store(texts.select("id", "key", "size").join(_ends(links), "id"))
    total = 8 * (linked.agg(F.sum("size")).first()[0] or 0)
    placed, wanted = _cells(links, max(1, -(-total // SLICE_OF_SETS)))
    wanted = scratch.store(wanted.join(linked.select("id", "key"), "id"))
    # Few linked texts are marked at the scan, and only their sets are shuffled; many meet in a join by key.
    sets = rows.select("key", "__text").join(small_side(linked.select("key"), written=True), "key", "left_semi").mapInArrow(
        _sets(shingle), "key binary, shingles binary")
    near = sets.join(small_side(wanted, written=True), "key").select(F.col("part").alias("at"), "id", "shingles")
    found = placed.groupBy("part").cogroup(near.groupBy("at")).applyInArrow(_similar(similarity), "a bigint, b bigint")
    found = scratch.store(found)
    for done in (links, linked, wanted):
        scratch.drop(done)
    scratch.sweep()
    return found


def _able(similarity: float) -> Column:
    """Whether a pair can reach the similarity: at the first shingle of both prefixes what is left of either bounds what they share."""
    most = F.least(F.col("size_a") - F.col("pos_a"), F.col("size_b") - F.col("pos_b"))
    return most * (1 + similarity) >= similarity * (F.col("size_a") + F.col("size_b")) - 1e-6


def _reaching(placed: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """placed: block, id, size, pos, class. The rows of blocks of several classes that can be alike to any text of their block.

    A row far back in its prefix is only alike to shorter texts; the least size of the block tells whether there are such.
    """
    spans = [F.min("class").alias("lo"), F.max("class").alias("hi")]
    least = placed.groupBy("block").agg(F.min("size").alias("least"), *spans).filter("lo <> hi")
    least = scratch.store(least.select("block", "least"))
    partner = F.greatest(F.col("least"), F.col("size") * similarity)
    enough = (F.col("size") - F.col("pos")) * (1 + similarity) >= similarity * (F.col("size") + partner) - 1e-6
    near = scratch.store(placed.join(least, "block").filter(enough).drop("least"))
    mixed = scratch.store(near.groupBy("block").agg(*spans).filter("lo <> hi").select("block"))
    found = scratch.store(near.join(mixed, "block"))
    for done in (least, near, mixed):
        scratch.drop(done)
    return found


def _paired(left: DataFrame, right: DataFrame, wanted: Column) -> DataFrame:
    """Pairs a < b of rows of a block."""
    side = lambda df, c: df.select("block", *(F.col(n).alias(f"{n}_{c}") for n in df.columns if n != "block"))
    return side(left, "a").join(side(right, "b"), "block").filter(wanted).select(
        F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0), lambda total, n: total + n)


def _shared(texts: DataFrame, rows: DataFrame, shingle: int, scratch: Scratch) -> DataFrame:
    """texts: id, key. Of each the shingles it has in common with another one of them: id, shared (counts in PARTS parts)."""
    told = rows.select("key", "__text").join(small_side(texts.select("key"), written=True), "key", "left_semi").mapInArrow(
        _shingle_rows(shingle), "key binary, shingle bigint").distinct()
    told = scratch.store(told.join(texts, "key").select("id", "shingle"))
    common = scratch.store(told.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("shingle"))
    part = F.pmod("shingle", F.lit(PARTS))
    counts = F.array(*(F.count_if(part == p).cast("int") for p in range(PARTS)))
    found = scratch.store(told.join(common, "shingle").groupBy("id").agg(counts.alias("shared")))
    for done in (told, common):
        scratch.drop(done)
    return found


def _spread(texts: DataFrame) -> DataFrame:
    return texts.select("id", "size", F.posexplode("heads").alias("pos", "block"))


def _across(owned: DataFrame, texts: DataFrame, counts: DataFrame, common: tuple[np.ndarray, np.ndarray], rows: DataFrame,
            shingle: int, similarity: float, scratch: Scratch, bucket_rows: int) -> DataFrame:
    """Pairs a, b of different classes that meet first in a full block and may reach the similarity.

    owned: block, id, pos, class of the full blocks of several classes; counts: block, n of all. Such a block is full because
    the order took its shingle for a rare one. So full blocks become common ones, and the texts in them get new prefixes
    in that order, one for all of them: two that are alike have a first shingle in common there, and the places of that
    one tell whether they can be. A text with more shingles of its own than it may differ by has the common ones too far
    back to meet any text of its size, and a block whose other texts are one class is settled. Of more than `bucket_rows`
    pairs a text those stay that the shingles which both have in common with any other, counted in parts, allow.
    """
    members = owned.groupBy("id").agg(F.min("class").alias("class"), F.min("pos").alias("met"))
    members = scratch.store(members.join(texts.select("id", "key", "size", "heads"), "id"))
    order = with_full_blocks(common, counts.filter(F.col("n") > bucket_rows))[0]
    later = rows.select("key", "__text").join(small_side(members.select("key"), written=True), "key", "left_semi").mapInArrow(
        _heads(shingle, similarity, order), "key binary, later array<bigint>").dropDuplicates(["key"])
    # What a text has before its first such block it has in common with none whose first common shingle is such a block.
    new = F.array_except("later", F.slice("heads", F.lit(1), F.col("met")))
    new = F.transform(new, lambda b: F.struct((F.array_position("later", b) - 1).alias("pos"), b.alias("block")))
    placed = later.join(members, "key").select("id", "size", "class", F.explode(new).alias("at"))
    placed = placed.select("id", "size", "class", "at.pos", "at.block")
    placed = _reaching(scratch.store(placed), similarity, scratch)
    pairs = scratch.store(_paired(placed, placed, (F.col("class_a") < F.col("class_b")) & _able(similarity)).distinct())
    ends = _ends(pairs)
    if pairs.count() <= bucket_rows * ends.count():
        return pairs
    told = scratch.store(_shared(members.join(ends, "id").select("id", "key"), rows, shingle, scratch).join(members.select("id", "size"), "id"))
    of = lambda c: told.select(*(F.col(n).alias(f"{n}_{c}") for n in told.columns), F.col("id").alias(c))
    most = _total(F.zip_with("shared_a", "shared_b", lambda a, b: F.least(a, b)))
    enough = most * (1 + similarity) >= similarity * (F.col("size_a") + F.col("size_b")) - 1e-6
    return pairs.join(of("a"), "a").join(of("b"), "b").filter(enough).select("a", "b")


def similar_classes(rows: DataFrame, shingle: int, similarity: float, bits: int, scratch: Scratch,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """rows: key, __text. Returns node, root (least key) of the classes of texts tied by the similarity.

    Two sets of Jaccard similarity s have an element in common among the first n - ceil(s n) + 1 of each, in any order
    of the elements (Chaudhuri et al., "A Primitive Operator for Similarity Joins", 2006). With rare shingles first few
    texts meet by chance. SimHash pairs and all pairs of blocks of up to `bucket_rows` texts are verified; in fuller
    blocks each text is verified against two hubs: the text that has the block first in its prefix, so with fewest shingles
    of its own, and one of HUBS as the block has it. What that ties is one class, and a full block of one class is settled,
    but for texts that have it too far back for any partner (see _reaching); the texts of the others meet once more in an
    order that knows the full blocks (see _across). So no pair that reaches the similarity stays in different classes.
    """
    common = common_shingles(rows, shingle)
    cut = rows.mapInArrow(_prefixes(shingle, similarity, common[0]), "key binary, size int, fp bigint, parity binary, heads array<bigint>")
    texts = scratch.store(cut.dropDuplicates(["key"]).withColumn("id", F.monotonically_increasing_id()))
    first = scratch.store(texts.groupBy("fp").agg(F.min("id").alias("id")))
    near = close_links(first.select("fp"), bits, scratch, bucket_rows)
    of = lambda c: first.select(F.col("fp").alias(c), F.col("id").alias(f"id_{c}"))
    printed = near.join(of("a"), "a").join(of("b"), "b").select(
        F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))
    alike = texts.select("fp", "id").join(first.withColumnRenamed("id", "a"), "fp").filter("a <> id").select(
        "a", F.col("id").alias("b"))

    keyed = _spread(texts)
    counts = scratch.store(keyed.groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    placed = scratch.store(keyed.join(counts, "block"))
    scratch.sweep()
    few = placed.filter(F.col("n") <= bucket_rows).drop("n")
    full = placed.filter(F.col("n") > bucket_rows).drop("n")
    turn = F.xxhash64("id", F.pmod("block", F.lit(HUBS)))
    early = F.col("pos") / F.col("size")
    hubs = full.groupBy("block").agg(
        F.min(F.struct(early.alias("early"), -F.col("size"), turn.alias("turn"), "id", "size", "pos")).alias("first"),
        F.min(F.struct(turn.alias("turn"), "id", "size", "pos")).alias("any"))
    hubs = scratch.store(hubs.select("block", "first.id", "first.size", "first.pos").unionByName(
        hubs.select("block", "any.id", "any.size", "any.pos")).distinct())
    pairs = _paired(few, few, (F.col("id_a") < F.col("id_b")) & _able(similarity))
    stars = _paired(hubs, full, (F.col("id_a") != F.col("id_b")) & _able(similarity))
    proposals = scratch.store(printed.unionByName(alike).unionByName(pairs).unionByName(stars).distinct())
    links = verified(proposals, texts, rows, shingle, similarity, scratch)
    classes = scratch.store(components(links, scratch))

    owned = full.join(classes.withColumnRenamed("node", "id"), "id", "left")
    owned = owned.select("block", "id", "size", "pos", F.coalesce("root", "id").alias("class"))
    owned = _reaching(scratch.store(owned), similarity, scratch)
    for done in (placed, hubs, proposals, links, first):
        scratch.drop(done)
    if not owned.isEmpty():
        across = scratch.store(_across(owned, texts, counts, common, rows, shingle, similarity, scratch, bucket_rows))
        more = verified(across, texts, rows, shingle, similarity, scratch)
        tied = classes.select(F.col("node").alias("a"), F.col("root").alias("b"))
        classes = scratch.store(components(tied.unionByName(more), scratch))
    named = classes.join(texts.select(F.col("id").alias("node"), "key"), "node")
    roots = named.groupBy("root").agg(F.min("key").alias("least"))
    return named.join(roots, "root").select(F.col("key").alias("node"), F.col("least").alias("root"))


def keep_one_of_each(docs: DataFrame, id_column: str = "doc_id", shingle: int = 5, similarity: float = 0.8,
                     bits: int = 2, text: str = "text") -> DataFrame:
    """Rows of docs without the near copies: of each class the row with the least id stays.

    A link counts if the Jaccard similarity of the sets of five-word shingles reaches `similarity`; SimHash and shared
    shingles of rare-first prefixes propose them, and none is missed (see similar_classes). Equal texts are one class
    from the start, a null text is an empty one, and empty texts are one class. Of rows that share the least id of a
    class one stays. Very long texts make large sets, compared like any other; extra columns pass through.
    """
    scratch = Scratch(docs.sparkSession)
    key = F.unhex(F.md5(text_or_empty(text)))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), key.alias("key"), text_or_empty(text).alias("__text"))
    classes = similar_classes(rows.select("key", "__text"), shingle, similarity, bits, scratch)
    classes = classes.withColumnRenamed("node", "key")
    owners = scratch.store(rows.groupBy("key").agg(F.min("id").alias("id")))
    rooted = owners.join(classes, "key", "left").select("id", "key", F.coalesce("root", "key").alias("root"))
    stays = rooted.groupBy("root").agg(F.min(F.struct("id", "key")).alias("s")).select(
        F.col("s.id").alias("__id"), F.col("s.key").alias("__key"))
    own, own_key = spare_name("own", docs), spare_name("own_key", docs)
    marked = docs.withColumns({own: F.col(f"`{id_column}`"), own_key: key})
    stays = stays.withColumnsRenamed({"__id": own + "_", "__key": own_key + "_"})
    kept = marked.join(stays, (F.col(own_key) == F.col(own_key + "_")) & F.col(own).eqNullSafe(F.col(own + "_")))
    return kept.dropDuplicates([own_key]).select(*(F.col(f"`{c}`") for c in docs.columns))

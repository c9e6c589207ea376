"""Benchmark decontamination by latent semantic retrieval.

1. Terms of the benchmark items get inverse document frequencies counted over all documents.
2. A randomised SVD of the TF-IDF passages (all windows of all documents and items) gives a projection to `rank`
   dimensions. One scan counts how often two terms of the items stand in one window; that is the matrix of passages
   multiplied with itself, but for the weights. Subspace iteration then only needs this table of pairs of terms: Spark
   tasks multiply it with the current basis and add up the products per term; the driver only makes the terms x rank
   basis orthonormal again.
3. Every document is cut into windows of 48 words every 16 words, every item longer than a window into passages of
   48 words every 32 words.
   Windows whose cosine with an item or one of its passages in the latent space reaches `cosine` (less for
   items shorter than a window), and that carry `cover` of its weight, propose the item, so paraphrases
   with other word order are found too.
4. A proposal counts if the longest common subsequence of the item and the words around the window (for a
   passage: around the place of the whole item)
   covers `share` of the item, and if it covers `share` of the answer (the text after the last
   "answer:", else the last sentence of at least three words).

Scale: documents are scanned three times (frequencies, pairs of terms, search) and never shuffled. Vocabulary slots
are limited to `slots`, the pairs of terms that a task holds to `held_pairs` at a time. The vectors of items and
passages come in blocks of about `block_items`, each compared with all documents, so what a task holds is bounded for
any number of items or documents. All proposals above the cosine are checked.

Edge cases: null and blank texts and items match nothing; items of fewer than three words are found by
the same rules; equal items are all reported; repeated rows give repeated matches; empty tables give an
empty result. Words are split at ASCII space and punctuation with A-Z folded.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, text_or_empty

BLOCK = 16
WINDOW_BLOCKS = 3
# Cells of a table of common subsequences; larger ones are cut in two.
CELLS = 1 << 24
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@dataclass(frozen=True)
class LeakRules:
    slots: int = 1 << 14
    rank: int = 128
    spare: int = 8
    passes: int = 2
    cosine: float = 0.5
    cover: float = 0.35  # share of an item's weight that a window must carry
    share: float = 0.6
    common: float = 0.05  # terms in more than this share of all documents say little about a passage
    least_terms: int = 5  # but the rarest terms of an item always count
    block_items: int = 4096
    held_pairs: int = 1 << 21


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def answer_start(text: bytes) -> int:
    """Index of the first word of the answer part of an item."""
    lower = text.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
    at = lower.rfind(b"answer:")
    if at >= 0:
        return len(terms_of(text[:at])) + 1
    total, start = len(terms_of(text)), 0
    parts = [p for p in lower.replace(b"\n", b". ").replace(b"? ", b". ").replace(b"! ", b". ").split(b". ")]
    seen = 0
    for part in parts:
        n = len(terms_of(part))
        if n >= 3:
            start = seen
        seen += n
    return min(start, max(0, total - 1))


def passage_starts(words: int) -> list[int]:
    """First words of the overlapping passages of an item longer than a window; together they cover it."""
    last = words - BLOCK * WINDOW_BLOCKS
    return [*range(0, last, 2 * BLOCK), last] if last > 0 else []


def _common_lengths(item: list[bytes], text: list[bytes]) -> np.ndarray:
    """Length of the longest common subsequence of item with each prefix of text."""
    codes: dict[bytes, int] = {}
    left = [codes.setdefault(w, len(codes)) for w in item]
    right = np.array([codes.get(w, -1) for w in text], np.int64)
    row = np.zeros(len(text) + 1, np.int32)
    for code in left:
        row[1:] = np.maximum.accumulate(np.maximum(np.where(right == code, row[:-1] + 1, 0), row[1:]))
    return row


def common_positions(item: list[bytes], text: list[bytes]) -> list[int]:
    """Positions of item that take part in one longest common subsequence with text."""
    if len(item) > 1 and (len(item) + 1) * (len(text) + 1) > CELLS:
        half = len(item) // 2
        back = _common_lengths(item[half:][::-1], text[::-1])[::-1]
        cut = int(np.argmax(_common_lengths(item[:half], text) + back))
        later = common_positions(item[half:], text[cut:])
        return common_positions(item[:half], text[:cut]) + [half + p for p in later]
    rows = np.zeros((len(item) + 1, len(text) + 1), np.int32)
    codes: dict[bytes, int] = {}
    left = [codes.setdefault(w, len(codes)) for w in item]
    right = np.array([codes.get(w, -1) for w in text], np.int64)
    for i, code in enumerate(left):
        grown = np.where(right == code, rows[i, :-1] + 1, rows[i, 1:])
        rows[i + 1, 1:] = np.maximum.accumulate(np.maximum(grown, rows[i, 1:]))
    out, j = [], len(text)
    for i in range(len(item), 0, -1):
        while j > 0 and rows[i, j] == rows[i, j - 1]:
            j -= 1
        if rows[i, j] > rows[i - 1, j]:
            out.append(i - 1)
            j -= 1
    return out[::-1]


def _slots(texts: list[bytes], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The slots of the words (terms_of) of all texts one after another, -1 for words without one, and the words of each text."""
    ends = np.cumsum([0, *map(len, texts)])
    joined = [None, pa.py_buffer(ends), pa.py_buffer(b"".join(texts).translate(_FOLD))]
    lists = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(texts), joined))
    words = lists.values
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # around spaces at the ends of a text there are empty ones
    names = pa.array(list(vocabulary), pa.large_binary()).view(pa.large_string())
    slot_of = np.array([*vocabulary.values(), -1], np.int32)
    found = slot_of[pc.index_in(words, names).fill_null(len(names)).to_numpy()]
    return found[real], np.diff(np.concatenate(([0], np.cumsum(real)))[lists.offsets.to_numpy()])


class Blocks:
    """Blocks of BLOCK words of some texts: the terms in them and sums of term vectors per window."""

    def __init__(self, texts: list[bytes], vocabulary: dict[bytes, int], weight: np.ndarray):
        self.words, lengths = _slots(texts, vocabulary)
        self.first = np.concatenate(([0], np.cumsum(lengths)))  # word of each text
        counts = -(-lengths // BLOCK)
        ends = np.cumsum(counts)
        at = np.flatnonzero(self.words >= 0)
        at = at[weight[self.words[at]] > 0]
        text = np.searchsorted(self.first, at, "right") - 1
        self.ids, self.block_of, self.count = self.words[at], (at - self.first[text]) // BLOCK + (ends - counts)[text], int(ends[-1])
        self.owner = np.repeat(np.arange(len(texts)), counts)
        self.start = np.arange(self.count) - np.repeat(ends - counts, counts)
        self.edges = np.flatnonzero(np.diff(self.block_of, prepend=-1))

    def slots(self, text: int) -> np.ndarray:
        return self.words[self.first[text] : self.first[text + 1]]

    def _ahead(self, rows: np.ndarray) -> np.ndarray:
        """Sums of each block and the next ones of its window, of the same text."""
        out = rows.copy()
        for k in range(1, WINDOW_BLOCKS):
            same = np.flatnonzero(self.owner[:-k] == self.owner[k:]) if self.count > k else np.zeros(0, np.int64)
            out[same] += rows[same + k]
        return out

    def windows(self, weighted: np.ndarray) -> np.ndarray:
        """The latent vector of the window that starts at each block; weighted: the basis times the weights of the terms."""
        sums = np.zeros((self.count, weighted.shape[1]), np.float32)
        at, size = self.edges, np.diff(self.edges, append=len(self.ids))
        while len(at):  # one more term of each block that has as many
            sums[self.block_of[at]] += weighted[self.ids[at]]
            at, size = at[size > 1] + 1, size[size > 1] - 1
        return self._ahead(sums)

    def pairs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys a * n + b of terms a <= b, each once, and the product of their counts summed over all windows."""
        at, lag, keys, times = np.arange(len(self.ids)), 0, [], []
        while len(at):
            # x stands before y; they share the windows that start between the last that reaches y and x itself
            x, y = at, at + lag
            a, b = self.ids[x].astype(np.int64), self.ids[y].astype(np.int64)
            first, last = self.start[self.block_of[x]], self.start[self.block_of[y]]
            keys.append(np.minimum(a, b) * n + np.maximum(a, b))
            times.append((first - np.maximum(0, last - WINDOW_BLOCKS + 1) + 1) * np.where((a == b) & (lag > 0), 2, 1))
            lag += 1
            at = at[at + lag < len(self.ids)]
            x, y = self.block_of[at], self.block_of[at + lag]
            at = at[(y - x < WINDOW_BLOCKS) & (self.owner[x] == self.owner[y])]
        return _summed(keys, times)


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    none = [np.zeros(0, np.int64)]
    keys, where = np.unique(np.concatenate(keys + none), return_inverse=True)
    out = np.zeros(len(keys), np.int64)
    np.add.at(out, where, np.concatenate(times + none))
    return keys, out


def _together(vocabulary: dict[bytes, int], weight: np.ndarray, held: int):
    """Pairs of terms of one window and the product of their counts, summed over the windows of a task."""
    n = len(weight)

    def rows(keys: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], ["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = [], []
        for batch in batches:
            for _, piece in slices(batch.column("__text")):
                for out, part in zip((keys, times), Blocks(piece, vocabulary, weight).pairs(n)):
                    out.append(part)
                if sum(map(len, keys)) > held:
                    keys, times = ([x] for x in _summed(keys, times))
                    if len(keys[0]) > held // 2:
                        yield rows(keys.pop(), times.pop())
        yield rows(*_summed(keys, times))

    return run


def _products(weight: np.ndarray, basis: np.ndarray):
    """Per term the sum over windows of its weighted count times the projection of the window."""
    n = len(weight)
    weighted = basis * weight[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(basis.shape, np.float64)
        for batch in batches:
            pairs, counts = batch.column("pair").to_numpy(), batch.column("n").to_numpy()
            for low in range(0, len(pairs), 1 << 14):
                a, b = np.divmod(pairs[low : low + (1 << 14)], n)
                times = counts[low : low + (1 << 14), None]
                two = a != b
                np.add.at(total, a, times * weighted[b])
                np.add.at(total, b[two], times[two] * weighted[a[two]])
        total *= weight[:, None]
        rows = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(total[rows].tolist(), pa.list_(pa.float64()))], ["slot", "value"])

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for slot, value in zip(batch.column("slot").to_pylist(), batch.column("value").to_pylist()):
            total[slot] = total[slot] + np.array(value) if slot in total else np.array(value)
    keys = sorted(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array([total[k].tolist() for k in keys], pa.list_(pa.float64()))],
        ["slot", "value"])


def latent_basis(pairs: DataFrame, weight: np.ndarray, rules: LeakRules) -> np.ndarray:
    """Right singular vectors (terms x rank) of the weighted passages by randomised subspace iteration.

    pairs: pair (a * terms + b) and n, the product of the counts of terms a <= b summed over all passages.
    """
    n = len(weight)
    width = min(rules.rank + rules.spare, n)
    basis = np.linalg.qr(np.random.default_rng(42).standard_normal((n, width)))[0].astype(np.float32)
    slots = max(8, pairs.sparkSession.sparkContext.defaultParallelism)
    schema = "slot bigint, value array<double>"
    for _ in range(rules.passes):
        parts = pairs.mapInArrow(_products(weight, basis), schema)
        summed = parts.repartition(slots, "slot").mapInArrow(_add_up, schema).collect()
        product = np.zeros((n, width))
        for row in summed:  # at most `slots` terms
            product[row["slot"]] = row["value"]
        basis, _, _ = np.linalg.svd(product, full_matrices=False)
        basis = basis.astype(np.float32)
    return np.ascontiguousarray(basis[:, : rules.rank])


def _search(keep: list[str], vocabulary, weight, basis, items: list[tuple], queries: list[tuple], vectors: np.ndarray,
            rules: LeakRules):
    """items: (item id, words, first word of the answer); queries: (item, first word of the passage or None for
    the whole item); vectors: the rows of the queries in the latent space."""
    lengths = np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)
    # In a longer window a short item is only a part of the vector, so less cosine is asked for.
    least = rules.cosine * np.sqrt(np.minimum(1.0, [len(items[i][1]) / (BLOCK * WINDOW_BLOCKS) for i, _ in queries]))
    step = max(64, (1 << 26) // max(4096, len(queries)))
    bags = [Counter(item) for _, item, _ in items]
    slotted = [np.unique([vocabulary[w] for w in item], return_counts=True) for _, item, _ in items]
    weighted, directions, carries = basis * weight[:, None], (vectors / lengths[:, None]).T, rules.cover * lengths

    def around(i: int, found: list[tuple[int, float, int | None]]) -> dict[tuple[int, int], tuple[int, float]]:
        """The words around the windows found for item i, and the first such window: its block and cosine."""
        n = len(items[i][1])
        slack = n // 2 + BLOCK
        out: dict[tuple[int, int], tuple[int, float]] = {}
        for start, cosine, at in found:
            # A passage tells where the whole item would be, a whole item may be anywhere around the window.
            low, high = start * BLOCK, (start + WINDOW_BLOCKS) * BLOCK
            if at is not None:
                low, high = low - at, low - at + n
            out.setdefault((max(0, low - slack), high + slack), (start, cosine))
        return out

    def able(i: int, codes: np.ndarray, low: int, high: int) -> bool:
        """Whether words low to high have enough of item i's slots; the bags below look at the words themselves."""
        most = slotted[i][1]
        held = np.bincount(codes[low : max(low, high)], minlength=len(most) + 1)[1:]
        return np.add.reduce(np.minimum(held, most)) >= rules.share * len(items[i][1])

    def match(words: list[bytes], i: int, regions: dict[tuple[int, int], tuple[int, float]]):
        """The best passage among the regions found for item i, or None."""
        item_id, item, answer = items[i]
        best = None
        for (low, high), (start, cosine) in regions.items():
            region = words[low:high]
            # A subsequence has no more words than the bags have in common.
            known = list(filter(bags[i].__contains__, region))
            if len(known) < rules.share * len(item):
                continue
            if sum(min(n, bags[i][w]) for w, n in Counter(known).items()) < rules.share * len(item):
                continue
            held = common_positions(item, region)
            share = len(held) / len(item)
            told = sum(p >= answer for p in held) / (len(item) - answer)
            if share >= rules.share and told >= rules.share:
                best = max(best or (0.0, 0.0, 0.0, 0), (share, told, cosine, -start * BLOCK))
                if share == 1.0:
                    break
        return best and (item_id, best[2], best[0], best[1], -best[3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], [[] for _ in range(5)]
            for first, piece in slices(batch.column("__text")):
                blocks = Blocks(piece, vocabulary, weight)
                windows = blocks.windows(weighted)
                near: dict[tuple[int, int], list[tuple[int, float, int | None]]] = {}
                for at in range(0, blocks.count, step):
                    part = windows[at : at + step]
                    carried = part @ directions
                    # Few windows carry enough of an item, so only their cosines are looked at.
                    row, query = np.divmod(np.flatnonzero(carried >= carries), len(queries))
                    cosines = carried[row, query] / np.maximum(np.linalg.norm(part, axis=1), 1e-12)[row]
                    close = cosines >= least[query]
                    row, query, cosines = at + row[close], query[close], cosines[close]
                    for t, start, q, cosine in zip(
                            blocks.owner[row].tolist(), blocks.start[row].tolist(), query.tolist(), cosines.tolist()):
                        near.setdefault((t, queries[q][0]), []).append((start, cosine, queries[q][1]))
                left = {}
                of_item, code = None, np.zeros(len(weight) + 1, np.int32)  # the last for words of no item
                for t, i in sorted(near, key=lambda x: x[::-1]):
                    if i != of_item:
                        of_item, code[:] = i, 0
                        code[slotted[i][0]] = np.arange(1, len(slotted[i][0]) + 1)
                    codes = code[blocks.slots(t)]
                    if not able(i, codes, 0, len(codes)):
                        continue
                    regions = around(i, sorted(near[t, i], key=lambda x: (-x[1], x[0])))
                    if not able(i, codes, min(regions)[0], max(high for _, high in regions)):
                        continue
                    regions = {x: window for x, window in regions.items() if able(i, codes, *x)}
                    if regions:
                        left[t, i] = regions
                cut: dict[int, list[bytes]] = {}
                for (t, i), regions in sorted(left.items()):
                    if t not in cut:
                        cut = {t: terms_of(piece[t])}
                    hit = match(cut[t], i, regions)
                    if hit:
                        rows.append(first + t)
                        for column, value in zip(out, hit):
                            column.append(value)
            kept = [batch.column(c).take(pa.array(rows, pa.int64())) for c in keep]
            types = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
            columns = kept + [pa.array(c, t) for c, t in zip(out, types)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "item_id", "cosine", "lcs_share", "answer_share", "word"])

    return run


def _flag(search, keep: list[str]):
    """All rows with `__leaked`: whether the search reports them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = pa.array(range(batch.num_rows), pa.int64())
            numbered = pa.RecordBatch.from_arrays([numbers, batch.column("__text")], ["__row", "__text"])
            hit = {r for found in search(iter([numbered])) for r in found.column("__row").to_pylist()}
            flags = pa.array([r in hit for r in range(batch.num_rows)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), flags], [*keep, "__leaked"])

    return run


def drop_leaks(docs: DataFrame, items: DataFrame, rules: LeakRules = LeakRules(), text: str = "text") -> DataFrame:
    """docs without the rows that hold a leak, in one scan and without a shuffle for each block of items."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # any names may stand in docs, also those used here
    out = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in out.schema.fields)
    for model in _models(docs, items, rules, Scratch(docs.sparkSession), text, "item_id", "text"):
        rows = out.select("*", text_or_empty(names[text]).alias("__text"))
        search = _search(["__row"], *model, rules)
        flagged = rows.mapInArrow(_flag(search, out.columns), f"{fields}__leaked boolean")
        out = flagged.filter(~F.col("__leaked")).drop("__leaked")
    return out.select(*(F.col(n).alias(c) for c, n in names.items()))


def find_leaks(docs: DataFrame, items: DataFrame, keep: list[str], rules: LeakRules = LeakRules(),
               text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per leak: `keep` columns of docs, item_id, cosine, lcs_share, answer_share, word (position)."""
    spark = docs.sparkSession
    rows = docs.select(*keep, text_or_empty(text).alias("__text"))
    schema = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)
    schema += "item_id bigint, cosine double, lcs_share double, answer_share double, word bigint"
    out = spark.createDataFrame([], schema)
    for model in _models(docs, items, rules, Scratch(spark), text, item_id, item_text):
        out = out.unionByName(rows.mapInArrow(_search(keep, *model, rules), schema))
    return out


def _models(docs: DataFrame, items: DataFrame, rules: LeakRules, scratch: Scratch, text: str, item_id: str,
            item_text: str) -> Iterator[tuple]:
    """For each block of items: vocabulary, term weights, basis, items, queries, query vectors."""
    rows = docs.select(text_or_empty(text).alias("__text"))
    wanted = items.filter(F.col(item_text).isNotNull()).select(
        F.col(item_id).cast("bigint").alias("id"), F.col(item_text).alias("text"))
    passages = F.greatest(F.lit(0), F.size(F.split("text", r"[\s\p{Punct}]+")) - BLOCK) / (2 * BLOCK)
    count = wanted.agg(F.sum(1 + F.floor(passages)).alias("n")).first()["n"] or 0
    blocks = -(-count // rules.block_items)
    part = F.pmod(F.xxhash64("id"), F.lit(max(1, blocks)))
    for b in range(blocks):
        # One block of items is small; hashing may make blocks a little larger than block_items.
        block = wanted.filter(part == b).orderBy("id", "text").collect()
        words = [(r["id"], terms_of(r["text"].encode()), answer_start(r["text"].encode())) for r in block]
        words = [x for x in words if x[1]]
        if words:
            yield _block_model(rows, words, rules, scratch)


def _block_model(rows: DataFrame, items: list[tuple], rules: LeakRules, scratch: Scratch) -> tuple:
    spark = rows.sparkSession
    names = sorted({w for _, item, _ in items for w in item})
    # Beyond `slots` names several share a slot.
    vocabulary = {w: i % rules.slots for i, w in enumerate(names)}
    n = min(len(names), rules.slots)
    counted = rows.select("__text").mapInArrow(_frequencies_by_slot(vocabulary, n), "slot bigint, n bigint")
    seen = {r["slot"]: r["n"] for r in counted.groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    total = seen.pop(n, 0)
    weight = np.array([np.log((total + 1) / (seen.get(i, 0) + 1)) + 0.1 for i in range(n)], np.float32)
    slot_counts = np.array([seen.get(i, 0) for i in range(n)])
    kept = slot_counts <= max(20, rules.common * total)
    for _, item, _ in items:
        own = sorted({vocabulary[w] for w in item}, key=lambda i: (slot_counts[i], i))
        kept[own[: rules.least_terms]] = True
    weight[~kept] = 0.0
    own = spark.createDataFrame([(b" ".join(item).decode("utf-8", "replace"),) for _, item, _ in items], "__text string")
    passages = rows.select("__text").unionByName(own)
    counted = passages.mapInArrow(_together(vocabulary, weight, rules.held_pairs), "pair bigint, n bigint")
    pairs = scratch.store(counted.groupBy("pair").agg(F.sum("n").alias("n")))
    basis = latent_basis(pairs, weight, rules)
    queries = [(i, at) for i, (_, item, _) in enumerate(items) for at in (None, *passage_starts(len(item)))]
    vectors = np.zeros((len(queries), basis.shape[1]), np.float32)
    for k, (i, at) in enumerate(queries):
        words = items[i][1] if at is None else items[i][1][at : at + BLOCK * WINDOW_BLOCKS]
        ids = [vocabulary[w] for w in words]
        vectors[k] = (basis[ids] * weight[ids][:, None]).sum(axis=0)
    return vocabulary, weight, basis, items, queries, vectors


def _frequencies_by_slot(vocabulary: dict[bytes, int], n: int):
    """Documents per slot, and the number of documents at slot n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n + 1, np.int64)
        for batch in batches:
            for _, piece in slices(batch.column("__text")):
                words, lengths = _slots(piece, vocabulary)
                once = np.unique((np.repeat(np.arange(len(piece)), lengths) * n + words)[words >= 0])
                counts += np.bincount(once % n, minlength=n + 1)
                counts[n] += len(piece)
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(counts[slots])], ["slot", "n"])

    return run

"""Repeated phrases: passages of `length` words that start in more than one place are removed.

Recurring passages are confirmed over the whole corpus (see recurrence.py). The passages confirmed for a
shard of texts (one Arrow slice of a hash partition, about 4 MB) are compiled into an Aho-Corasick
automaton over words, and the texts of the shard stream through it. Every occurrence it reports marks its
words. The patterns are single windows of `length` words: the first and last of each confirmed run and
one every `length` words between them, which together cover the run, so an automaton stays small.

Texts without a repeated gram can hold no occurrence of any passage; they stream through without an
automaton and are only counted.

Edge cases: null and blank texts have no words; copies of a text of `length` words or more are removed
whole, both of them; repeated rows are copies; empty tables give an empty result; occurrences may overlap.
Numbers given to words by an automaton are exact within its shard (a dictionary, not a hash).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices
from .recurrence import Scheme, find_blocks, prepared, range_arrays, ranges_of, runs_of, windows_in_parts

GRAM = 6


def automaton(texts: list[tuple[int, ...]], ranges: list[tuple[np.ndarray, np.ndarray]], length: int):
    """All confirmed passages of a shard as one automaton over word numbers; None if there are none."""
    machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for words, own in zip(texts, ranges):
        for first, last in zip(*(x.tolist() for x in runs_of(*own))):
            for start in {*range(first, last + 1, length), last}:
                machine.add_word(words[start : start + length])
    if not len(machine):
        return None
    machine.make_automaton()
    return machine


def _result(words: list[bytes], gone: np.ndarray) -> tuple[int, int, str]:
    kept = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _columns(batch: pa.RecordBatch, keep: list[str], rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    values = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in keep), *values], [*keep, "n_words", "n_removed", "kept_sha256"])


def _locate(keep: list[str], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ranges = [], range_arrays(batch.column("ranges"))
            for start, piece in slices(batch.column("__text")):
                numbers: dict[bytes, int] = {}
                words = [t.split() for t in piece]
                coded = [tuple(numbers.setdefault(w, len(numbers)) for w in ws) for ws in words]
                machine = automaton(coded, ranges[start : start + len(piece)], length)
                for ws, code in zip(words, coded):
                    edges = np.zeros(len(ws) + 1, np.int64)
                    if machine is not None and code:
                        for end, _ in machine.iter(code):
                            edges[end - length + 1] += 1
                            edges[end + 1] -= 1
                    rows.append(_result(ws, np.cumsum(edges)[: len(ws)] > 0))
            yield _columns(batch, keep, rows)

    return run


def _untouched(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, piece in slices(batch.column("__text")):
                for text in piece:
                    words = text.split()
                    rows.append(_result(words, np.zeros(0, bool)))
            yield _columns(batch, [*keep, "k"], rows)

    return run


def remove_phrases(docs: DataFrame, keep: list[str], length: int = 35, text: str = "text") -> DataFrame:
    """Columns `keep` of docs with n_words, n_removed and kept_sha256 (kept words joined by a space)."""
    scratch = Scratch(docs.sparkSession)
    scheme = Scheme("words", length, min(GRAM, length))
    rows = prepared(docs, keep, text)
    found = find_blocks(rows, keep, scheme, scratch)
    single = windows_in_parts(found.candidates, found.parts, scheme, scratch)
    ranges = scratch.store(ranges_of(found.whole, single))
    fields = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)
    schema = f"{fields}n_words bigint, n_removed bigint, kept_sha256 string"
    joined = found.candidates.select(*keep, "key", "__text").join(ranges, "key", "left")
    touched = joined.mapInArrow(_locate(keep, length), schema)
    keyed = rows.withColumn("k", F.xxhash64("__text"))
    plain = keyed.mapInArrow(_untouched(keep), schema.replace("n_words", "k bigint, n_words", 1))
    return touched.unionByName(plain.join(found.repeated_keys, "k", "left_anti").drop("k"))

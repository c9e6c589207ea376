"""Token counts with a digest cache: texts that were counted before are never encoded again.

A cache is a Parquet folder partitioned by `version`, the digest of the tokenizer file and of the
library that runs it; a row is the SHA-256 of a text and its number of tokens. One call reads the
rows of its version, encodes each distinct missing text once and appends the new rows. Appends are
committed by the Parquet writer as a whole; two calls that append the same text leave two equal rows,
which the reader folds into one.

Edge cases: a null text counts as empty (0 bytes, 0 tokens); empty tables give empty results and an
untouched cache; repeated rows are counted from one encoding and all returned.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from importlib.metadata import version as library_version

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, text_digest, text_or_empty

CACHE_SCHEMA = "digest binary, n_tokens bigint, version string"


def version_digest(tokenizer: str) -> str:
    """SHA-256 over the tokenizer file and the name and version of its library."""
    library = "tokenizers" if tokenizer.endswith(".json") else "sentencepiece"
    state = hashlib.sha256(f"{library} {library_version(library)}\n".encode())
    with open(tokenizer, "rb") as file:  # a local program file like any Python module, not an input table
        for block in iter(lambda: file.read(1 << 20), b""):
            state.update(block)
    return state.hexdigest()


@lru_cache(maxsize=4)
def load_tokenizer(tokenizer: str):
    """The counting function of a tokenizer file; kept for the life of a Python worker."""
    if tokenizer.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(tokenizer)
        model.no_truncation()
        model.no_padding()

        def count(texts: list[str]) -> list[int]:
            return [len(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)]

        return count
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=tokenizer)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def _encoder(tokenizer: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load_tokenizer(tokenizer)
        for batch in batches:
            for start, texts in slices(batch.column("text")):
                counts = count([t.decode("utf-8", "replace") for t in texts])
                digests = batch.column("digest").slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([digests, pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return encode


def read_cache(spark, cache: str, version: str) -> DataFrame | None:
    """The stored counts of one tokenizer version, one row per digest; None while nothing is stored."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.filter(F.col("version") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, text: str = "text") -> DataFrame:
    """Add n_bytes and n_tokens to every row of docs and fill the cache with the texts it lacked.

    Only the missing texts are shuffled, once each per input split: copies are dropped before the
    shuffle, so a text that fills a third of the table reaches one task as a handful of rows.
    """
    spark = docs.sparkSession
    version = version_digest(tokenizer)
    texts = docs.select(text_digest(text).alias("digest"), text_or_empty(text).alias("text"))
    distinct = texts.dropDuplicates(["digest"])
    known = read_cache(spark, cache, version)
    misses = distinct if known is None else distinct.join(known, "digest", "left_anti")
    encoded = misses.mapInArrow(_encoder(tokenizer), "digest binary, n_tokens bigint")
    encoded.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(cache)
    # Stored, so that the join reads both sides from a shuffle and can split the digest of a hot text.
    counts = Scratch(spark).store(read_cache(spark, cache, version)).withColumnsRenamed({"digest": "__digest", "n_tokens": "__n_tokens"})
    keyed = docs.withColumns({
        "__digest": text_digest(text),
        "n_bytes": F.octet_length(text_or_empty(text)).cast("bigint"),
    })
    joined = keyed.join(counts, "__digest", "left")
    return joined.withColumn("n_tokens", F.coalesce("__n_tokens", F.lit(0)).cast("bigint")).drop("__digest", "__n_tokens")

"""Helpers shared by the corpus operators: written intermediates, words, safe column names."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder

# Rows of text that one Python step handles together; long texts make smaller groups.
SLICE_BYTES = 4 << 20


class Scratch:
    """Tables written to the shared checkpoint folder during one call; `drop` frees one early."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = scratch_folder(spark)
        self.count = 0

    def store(self, df: DataFrame) -> DataFrame:
        """Write a table and read it back: the lineage ends in files that all executors see."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete the files of a stored table that no later step reads."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


    def sweep(self) -> None:
        """Let Spark's cleaner delete the shuffle files of tables that are stored and no longer referenced."""
        gc.collect()
        self.spark._jvm.System.gc()


def spare_name(wish: str, df: DataFrame) -> str:
    """A column name that df does not have in any case, nor any that only adds underscores to it."""
    name, taken = f"__{wish}", {c.lower().rstrip("_") for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def text_digest(name: str = "text") -> Column:
    """SHA-256 of the UTF-8 text (null: empty) as 32 bytes."""
    return F.unhex(F.sha2(text_or_empty(name), 256))


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ as UTF-8; bytes.split() cuts at exactly these six characters."""
    if not text:
        return []
    return (text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")).split()


def slices(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) pieces of a string column of about SLICE_BYTES; null is empty."""
    start, size, piece = 0, 0, []
    column = column.cast(pa.large_binary())
    for i in range(len(column)):
        text = column[i].as_py() or b""
        piece.append(text)
        size += len(text) + 64
        if size >= SLICE_BYTES:
            yield start, piece
            start, size, piece = i + 1, 0, []
    if piece:
        yield start, piece

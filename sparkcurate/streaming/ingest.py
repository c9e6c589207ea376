"""Flat-file ingest as a stream: new files are parsed by the same columns and appended.

The records carry no event time and no state is kept between batches; the
checkpoint makes every file count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.qc import QualityRules, row_checks
from ..sources.flatfile import RECORD_END, parse_flat_records, record_blocks, with_metadata


def stream_flat_files(spark: SparkSession, folder: str) -> DataFrame:
    blocks = record_blocks(spark.readStream.option("lineSep", RECORD_END).text(folder))
    return with_metadata(parse_flat_records(blocks))


def flag_rows(records: DataFrame, rules: QualityRules) -> DataFrame:
    """The checks that need one row only; group-relative ones run on the table written."""
    return records.withColumns(row_checks(rules))


def append_parquet(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    writer = records.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)

"""Small text tables: annotations, id maps, request lists, summary and status files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scale import attach_groups

ID_MAP_SCHEMA = "short_id STRING, accession STRING, display_name STRING"

# Columns of the status and leaf metadata files.
STATUS_COLUMNS = ["family", "ncbi_taxid", "molecule_region", "status", "lineage", "baltimore_class"]
METADATA_COLUMNS = [
    "short_id", "display_name", "accession", "species", "strain", "host",
    "collection_date", "location", "taxon_id", "length",
]
TARGET_LABELS = ("500", "100")
# Rows of a leaf metadata file.
FILE_ROWS = 1 << 20
# The columns of the family summary, in file order.
SUMMARY_COLUMNS = [
    "family",
    "ncbi_taxid",
    "lineage",
    "baltimore_class",
    "molecule_region",
    "species_discovered",
    "species_with_seqs",
    "species_relaxed_threshold",
    "seqs_passing_qc",
    "qc_excluded_organism",
    "qc_excluded_length",
    "qc_excluded_ambiguity",
    "qc_undefined",
    "seqlen_min",
    "seqlen_q1",
    "seqlen_median",
    "seqlen_mean",
    "seqlen_q3",
    "seqlen_max",
    "seqlen_iqr",
    "tree500_leaves",
    "tree500_support_type",
    "tree500_support_min",
    "tree500_support_q1",
    "tree500_support_median",
    "tree500_support_q3",
    "tree500_support_max",
    "tree500_support_iqr",
    "tree500_cluster_thresh_min",
    "tree500_cluster_thresh_max",
    "tree500_msa_length",
    "tree500_msa_length_pre_trim",
    "tree500_msa_tool",
    "tree500_msa_options",
    "tree500_trim_tool",
    "tree500_trim_options",
    "tree500_msa_gap_pct",
    "tree500_tree_tool",
    "tree500_tree_options",
    "tree100_leaves",
    "tree100_support_type",
    "tree100_support_min",
    "tree100_support_q1",
    "tree100_support_median",
    "tree100_support_q3",
    "tree100_support_max",
    "tree100_support_iqr",
    "tree100_cluster_thresh_min",
    "tree100_cluster_thresh_max",
    "tree100_msa_length",
    "tree100_msa_length_pre_trim",
    "tree100_msa_tool",
    "tree100_msa_options",
    "tree100_trim_tool",
    "tree100_trim_options",
    "tree100_msa_gap_pct",
    "tree100_tree_tool",
    "tree100_tree_options",
    "tree500_n_outliers_removed",
    "tree100_n_outliers_removed",
    "tree500_n_length_outliers_long",
    "tree500_n_length_outliers_short",
    "tree100_n_length_outliers_long",
    "tree100_n_length_outliers_short",
    "tree500_n_refseq_absorbed",
    "tree100_n_refseq_absorbed",
    "tree500_n_genera",
    "tree100_n_genera",
    "tree500_n_subfamilies",
    "tree100_n_subfamilies",
    "tree500_concat_n_markers_target",
    "tree100_concat_n_markers_target",
    "tree500_concat_n_markers_used",
    "tree100_concat_n_markers_used",
    "tree500_concat_length",
    "tree100_concat_length",
    "tree500_marker_coverage",
    "tree100_marker_coverage",
    "tree100_marker_models",
]


def summary_columns() -> list[str]:
    """Columns of the family summary, in file order."""
    return list(SUMMARY_COLUMNS)


def read_tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", partitions: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).option("sep", "\t").option("header", True).option("escape", '"').option("emptyValue", "")
    (writer.partitionBy(*partitions) if partitions else writer).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def latest_by_key(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Last row of every key in input order."""
    fields = [c for c in df.columns if c not in (key, ordinal)]
    last = F.max_by(F.struct(*fields), F.col(ordinal)).alias("__last")
    return df.groupBy(key).agg(last).select(key, "__last.*")


def family_annotations(rows: DataFrame | None, ordinal: str = "ordinal") -> DataFrame | None:
    """family_key and the annotation columns; blank families dropped, the last duplicate wins.

    None stands for "no annotations": no table, or one without a family column.
    """
    if rows is None or "family" not in rows.columns:
        return None
    keyed = rows.withColumn("family_key", F.lower(F.trim("family"))).filter(F.length("family_key") > 0)
    return latest_by_key(keyed.drop("family"), "family_key", ordinal)


def read_family_annotations(spark: SparkSession, path: str) -> DataFrame | None:
    """Annotation file; input order is by file, split of the file and row in the split."""
    if not path_exists(spark, path):
        return None
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    rows = read_tsv(spark, path).withColumn("ordinal", place)
    return family_annotations(rows)


def summary_lineages(rows: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """family, lineage of the last summary row of each family."""
    named = rows.filter(F.length("family") > 0)
    return named.groupBy("family").agg(F.max_by("lineage", ordinal).alias("lineage"))


def request_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """Requested names: trimmed lines without blanks and comments."""
    return lines.select(F.trim(column).alias("family")).filter((F.col("family") != "") & ~F.col("family").startswith("#"))


def fixed_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order; unknown ones dropped, missing ones empty."""
    have = set(df.columns)
    return df.select(*[F.col(c).cast("string").alias(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def append_rows(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Append to a Parquet table of fixed columns."""
    fixed_columns(df, columns).write.mode("append").parquet(path)


def append_summary(df: DataFrame, path: str) -> None:
    append_rows(df, path, summary_columns())


def append_status(df: DataFrame, path: str) -> None:
    append_rows(df, path, STATUS_COLUMNS)


def leaf_metadata(rows: DataFrame, id_map: DataFrame) -> DataFrame:
    """The ten metadata columns with the display name joined in; short ids are unique within a family only."""
    group = [c for c in ("family",) if c in rows.columns and c in id_map.columns]
    named = rows.join(id_map.select(*group, "short_id", "display_name"), [*group, "short_id"], "left")
    return named.withColumn("display_name", F.coalesce("display_name", F.lit("")))


def write_leaf_metadata(rows: DataFrame, id_map: DataFrame, path: str) -> None:
    """One folder per family and target; groups without rows write nothing.

    The rows of a folder are brought together first, so that there is one file for each and not one for each task;
    a folder of more than FILE_ROWS rows has several.
    """
    folder = ["family", "target"]
    out = leaf_metadata(rows, id_map).select(*METADATA_COLUMNS, *folder)
    files = out.groupBy(*folder).agg(F.ceil(F.count(F.lit(1)) / FILE_ROWS).cast("bigint").alias("__files"))
    dealt = attach_groups(out, files, folder).withColumn("__file", F.pmod(F.xxhash64("accession", "short_id"), F.col("__files")))
    tasks = max(int(out.sparkSession.conf.get("spark.sql.shuffle.partitions")), out.sparkSession.sparkContext.defaultParallelism)
    write_tsv(dealt.repartition(tasks, *folder, "__file").drop("__files", "__file"), path, partitions=folder)

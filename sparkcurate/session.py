"""Session settings and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution re-plans from measured sizes: it broadcasts a join side only
# when its real size is below the threshold, and splits skewed join partitions.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # checkpoint files go when their table is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "sparkcurate", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, used between the rounds of iterative operators."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name beside the checkpoints, for tables written and read back."""
    return f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"


def stable_folder(spark: SparkSession, name: str) -> str:
    """A folder beside the checkpoints that later sessions find again under the same name.

    Without a shared folder in the settings (local mode) it lasts as long as the session.
    """
    return f"{spark.conf.get('spark.checkpoint.dir', None) or ensure_checkpoint_dir(spark)}/{name}"

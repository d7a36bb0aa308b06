"""Session construction and shared scratch space.

Scratch space (staging tables, stream checkpoints, lineage cuts) always lives
under the cluster's ``spark.checkpoint.dir`` so it is on shared storage; a
local default is only set when the setting is absent (tests, laptops).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Dimension-sized sides only: anything larger goes through a shuffle join. Parquet
    # sizes are compressed; the factor keeps the estimate on the safe side.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # Task sizes for large inputs: 128 MB scan splits and post-shuffle partitions of 16 MB (compressed; as rows they take
    # some six times that, and a task that joins and sorts holds them several times over).
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition values keep their written text (month = 'yyyyMM'); typed columns
    # come from explicit schemas.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "skyledger",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Session settings the operators rely on that can be changed at runtime.
RUNTIME_CONF = {k: v for k, v in BASE_CONF.items()
                if k.startswith("spark.sql.") and k != "spark.sql.execution.arrow.pyspark.enabled"}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings (UTC session zone, ANSI, AQE, partition value
    typing, dynamic overwrite) to a session built elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession, default: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    ``default`` is applied only when the session has none (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)         # DataFrame.checkpoint() writes here
    if not root:
        if default is None:
            raise RuntimeError("spark.checkpoint.dir is not set; configure shared storage for scratch data")
        spark.conf.set("spark.checkpoint.dir", default)
        spark.sparkContext.setCheckpointDir(default)
        root = default
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/skyledger/{purpose}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, purpose: str, under: str | None = None) -> DataFrame:
    """Write rows once under the shared checkpoint root and read them back: a lost executor repeats nothing before.
    ``under``: a scratch folder that its caller removes, in place of one of its own."""
    path = f"{under}/{purpose}-{uuid.uuid4().hex[:12]}" if under else scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_local_checkpoint_dir(spark: SparkSession, path: str) -> str:
    """Tests only: give a session without ``spark.checkpoint.dir`` a folder."""
    os.makedirs(path, exist_ok=True)
    return checkpoint_root(spark, default=path)

"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Only settings that hold at any data size; partition counts and memory belong
# to the submitting cluster. AQE splits skewed join partitions at run time.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}

# Fixed when a session starts: call-site capture costs several round trips to the
# JVM per Column operation.
_STATIC = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# Can be set on a running session. HotSpot never compiles methods above 8000 bytes
# of bytecode. A fused stage larger than that runs interpreted, more than ten times
# slower; below this limit Spark falls back to per-operator code split into small
# methods.
_RUNTIME = {"spark.sql.codegen.hugeMethodLimit": "8000"}
_SPARK_DEFAULTS = {"spark.sql.codegen.hugeMethodLimit": "65535"}


def build_session(app_name: str = "vitalmart", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **_STATIC, **_RUNTIME, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere; values the user chose stay."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key) == _SPARK_DEFAULTS[key]:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints: the cluster's, or a private one for tests.

    A cluster names a folder all executors share in ``spark.checkpoint.dir``; a
    machine-local folder is only set where that is absent (local test runs).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="vitalmart-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder

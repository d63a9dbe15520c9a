"""Session settings and the shared folder that written state lives in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on: UTC makes timestamp text (and so hashed
# keys) reproducible, AQE sizes partitions, splits hot keys and turns joins into
# broadcasts once the real size of a side is known.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # What a Python worker and the JVM beside it hold of a batch of texts, and keep when it is done.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the cluster's shared checkpoint folder.

    The folder is read from ``spark.checkpoint.dir``. Only a local session without
    that setting uses a folder below its warehouse.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    return "/".join([base.rstrip("/"), *parts])


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A shared path nobody has used before."""
    return shared_dir(spark, "siltstone", f"{label}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read back, for repeated use.

    Survives the loss of executors, and readers still prune columns and push filters.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

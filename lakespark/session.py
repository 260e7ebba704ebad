"""Session settings that every job in this package relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only, so that an already running session can be adjusted.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys are split at run time, also where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition values stay the strings that were written: a hash of digits is no number.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# The JVM never compiles a method above 8000 bytes. Stages of very many columns make such methods as one
# piece of code; with this limit they run operator by operator, in methods that are cut small.
WIDE_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def configure(spark: SparkSession, wide: bool = False) -> SparkSession:
    """Set what every job needs; with ``wide`` also what jobs on tables of very many columns need."""
    for key, value in (RUNTIME_CONF | (WIDE_CONF if wide else {})).items():
        spark.conf.set(key, value)
    return spark


_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` as the session has it.

    Where the setting is absent, a local session gets one temporary folder of its own;
    a cluster must name a folder that all executors share.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    # local-cluster has executors of its own
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="spark-")
    return _own_folder


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage before a step that reads its input several times. The table
    survives the loss of executors, and its size is known to the optimizer.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

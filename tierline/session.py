"""Where jobs may write intermediate data.

On a cluster, intermediate tables must live in shared storage: the folder the
cluster names in ``spark.checkpoint.dir``. Only when it is unset and the master
is ``local`` do we fall back to a fresh local folder, registered as the context's
checkpoint folder so that ``DataFrame.checkpoint()`` and later calls use it; on
any other master an unset folder is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; one is set only when none is configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext on a remote (Connect) session
        current = None
    if current:
        return current.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(
            f"spark.checkpoint.dir is not set: on {master} it must name a folder that the driver and all executors share"
        )
    local = tempfile.mkdtemp(prefix="tierline-ckpt-")
    try:
        # Registers the folder for DataFrame.checkpoint() and later calls.
        spark.sparkContext.setCheckpointDir(local)
    except Exception:  # no SparkContext on a remote (Connect) session
        pass
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    return f"{shared_dir(spark)}/tierline-scratch/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back: its lineage ends there, and Spark knows its size."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

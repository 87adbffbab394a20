"""Session defaults and the durable cut points used by iterative jobs."""

from __future__ import annotations

import posixpath
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the marts are written for (AQE on, UTC days)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Call-site capture costs several round trips per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured and driver and executors are one process
    (tests) a new temporary folder is made; a cluster without a shared folder
    is an error, as its machines would not see each other's files.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tidemark-ckpt-"))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return posixpath.join(spark.sparkContext.getCheckpointDir(), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder; survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

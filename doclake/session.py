"""Session settings and the shared folder that jobs write scratch data to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app_name: str = "doclake", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, falls back
    to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _LOCAL_DIRS:
        folder = tempfile.mkdtemp(prefix="doclake-")
        context.setCheckpointDir(folder)
        _LOCAL_DIRS[context.applicationId] = folder
    return _LOCAL_DIRS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

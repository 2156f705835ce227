"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with UTC event times; every other setting stays with spark-submit."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's, or a temporary one in local mode only.

    Also leaves the Spark context with a checkpoint folder, which boosted trees
    need to cut the lineage of their residuals.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if context.getCheckpointDir() is None:
        if configured is None and not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="eventlake-"))
    return configured or context.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{checkpoint_dir(spark).rstrip('/')}/eventlake/{name}-{uuid.uuid4().hex}"

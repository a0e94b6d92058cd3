"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package is written for. Adaptive execution splits
# skewed join partitions and turns joins with small sides into broadcasts once
# their real size is known.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_folders: dict[str, str] = {}  # application id -> temporary folder


def build_session(app: str = "mercata", master: str | None = None,
                  **conf: str) -> SparkSession:
    """Session with the package settings; ``conf`` entries override them
    (write dots as double underscores: ``spark__sql__shuffle__partitions``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    On a cluster that folder is shared, so what is written there outlives a lost
    executor. Only a local session that names none gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="mercata-")
        base = _local_folders[context.applicationId]
    return f"{base.rstrip('/')}/mercata/{label}-{uuid.uuid4().hex}"

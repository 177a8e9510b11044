"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(app_name: str = "newslens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, ANSI, AQE with skew-join splitting)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset and there is one machine (tests) is a local
    folder made, once per application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.getCheckpointDir():
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="newslens-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def working_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing has to be cleared first."""
    return f"{working_root(spark)}/{name}-{uuid.uuid4().hex}"


def apply_session_conf(spark: SparkSession) -> None:
    """Set what can be set on a session that somebody else has built."""
    for key, value in SESSION_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they need no installed copy."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="newslens-code-")
    name = os.path.basename(package)
    context.addPyFile(shutil.make_archive(f"{folder}/{name}", "zip", os.path.dirname(package), name))

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "routeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for: UTC, ANSI, adaptive execution.

    Partition counts are left to the cluster; adaptive execution coalesces small shuffles and
    splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # sessions are merged per task before the shuffle, so a hot key arrives pre-aggregated
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a local folder; on a cluster that is an error, because
    executors don't see each other's disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = os.path.join(tempfile.gettempdir(), "routeline-scratch")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root, safe against a concurrent or earlier run."""
    return f"{scratch_root(spark)}/routeline-{name}-{uuid.uuid4().hex}"

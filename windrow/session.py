"""Session start and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def open_session(app_name: str = "windrow", master: str | None = None, **conf: str) -> SparkSession:
    """Get the running session or start one. ``conf`` keys use ``__`` for dots.

    Only settings that change results are fixed here (the time zone); sizes such as
    ``spark.sql.shuffle.partitions`` belong to the cluster.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for working files that every executor can reach.

    It lies in the folder named by ``spark.checkpoint.dir``. Where that is unset, a
    machine-local folder is used on a local master only; a cluster must name one.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="windrow-")
    return f"{base.rstrip('/')}/windrow/{label}-{uuid.uuid4().hex}"

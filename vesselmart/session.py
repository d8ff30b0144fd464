"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # rows of both facts are staged by one task without sorting them first
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "vesselmart", **conf: str) -> SparkSession:
    """A session with the settings the library is tested under.

    Keyword settings use double underscores for dots:
    ``build_session("local[8]", spark__sql__shuffle__partitions="16")``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            for key in ("spark.driver.bindAddress", "spark.driver.host"):
                builder = builder.config(key, "127.0.0.1")
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vesselmart-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path (not yet created) below the shared folder."""
    return f"{shared_root(spark)}/vesselmart/{label}-{uuid.uuid4().hex}"

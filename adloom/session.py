"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the operators rely on; safe to call repeatedly."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app_name: str = "adloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; on a cluster ``master`` stays unset."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, visible to every executor.

    Only a local master may run without that setting; there a temporary folder
    of this machine is visible to all tasks by definition.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="adloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

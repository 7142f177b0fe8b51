"""Session settings and shared folders."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tremorline", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall back to a temporary
    folder. The fallback is remembered in the session so that every operator uses the same one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path not used before, below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it on reliable storage, as a table in the shared folder.

    ``checkpoint()`` would compute it twice, once to count and once to write.
    """
    spark = df.sparkSession
    path = new_folder(spark, "kept")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

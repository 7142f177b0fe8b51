"""Sample sources: any table or stream with a device, a time and a reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_samples(
    df: DataFrame,
    device: str | Column,
    ts: str | Column,
    value: str | Column,
    seq: str | Column,
    truth: str | Column | None = None,
) -> DataFrame:
    """Project ``df`` onto the sample schema.

    ``seq`` orders readings with equal time; ``(device, ts, seq)`` has to be unique. A missing reading
    becomes NaN and a missing truth flag becomes false, so neither can vanish from an aggregate.
    Works on static and streaming frames alike; times without a zone are read in the session zone,
    which has to be UTC.
    """
    flag = F.lit(False) if truth is None else F.coalesce(_column(truth), F.lit(False))
    return df.select(
        _column(device).cast("string").alias("device_id"),
        _column(ts).cast("timestamp").alias("ts"),
        _column(seq).cast("bigint").alias("seq"),
        F.coalesce(_column(value).cast("double"), F.lit(float("nan"))).alias("acceleration"),
        flag.alias("ground_truth"),
    )


def read_sample_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int = 64,
    pattern: str | None = None,
) -> DataFrame:
    """Stream Parquet files as they arrive, at most ``max_files`` per micro-batch.

    The limit bounds what one micro-batch, and so one device in it, can hold in memory.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)

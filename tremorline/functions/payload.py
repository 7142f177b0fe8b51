"""The JSON payload of a window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorline.functions.keys import batch_id, epoch_seconds
from tremorline.model import PAYLOAD_SCHEMA

CORRUPT = "_corrupt_record"


def window_payloads(windows: DataFrame) -> DataFrame:
    """One row per window: device, batch id and the payload fields."""
    return windows.select(
        "device_id",
        "window_id",
        "window_end",
        batch_id(F.col("window_end"), F.col("window_id")).alias("batch_id"),
        epoch_seconds(F.col("window_end")).alias("timestamp"),
        F.struct("rms", "mean", "std", "dominant_freq_hz").alias("features"),
        "anomaly_detected",
        "ground_truth",
    )


def encode_payload() -> Column:
    """Payload fields of the row as JSON text."""
    return F.to_json(F.struct(*[f.name for f in PAYLOAD_SCHEMA.fields]))


def decode_payload(text: Column, schema: T.StructType = PAYLOAD_SCHEMA) -> Column:
    """Parse JSON text; text that does not parse is kept in the struct's ``_corrupt_record`` field."""
    wanted = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})

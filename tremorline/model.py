"""Schemas shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("seq", T.LongType()),
        T.StructField("acceleration", T.DoubleType()),
        T.StructField("ground_truth", T.BooleanType()),
    ]
)

FAULT_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("start_ts", T.TimestampType()),
        T.StructField("end_ts", T.TimestampType()),
    ]
)

FEATURES_SCHEMA = T.StructType(
    [
        T.StructField("rms", T.DoubleType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
        T.StructField("dominant_freq_hz", T.DoubleType()),
    ]
)

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("features", FEATURES_SCHEMA),
        T.StructField("anomaly_detected", T.BooleanType()),
        T.StructField("ground_truth", T.BooleanType()),
    ]
)

PARTITION_COLUMNS = ["year", "month", "day", "device_id"]

LAKE_SCHEMA = T.StructType(
    [T.StructField("batch_id", T.StringType())]
    + PAYLOAD_SCHEMA.fields
    + [T.StructField(name, T.StringType()) for name in PARTITION_COLUMNS]
)

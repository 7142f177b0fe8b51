"""Batch ids, partition values and object keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The names of partition folders and of batches, ``year=YYYY/month=MM/day=DD/device_id=ID/batch_<ns>...json.gz``.


def epoch_seconds(ts: Column) -> Column:
    """Unix seconds as a double, with microseconds."""
    return F.unix_micros(ts) / F.lit(1e6)


def utc_timestamp(seconds: Column) -> Column:
    """Unix seconds (double) to a timestamp."""
    return F.timestamp_micros(F.round(seconds * F.lit(1e6)).cast("bigint"))


def partition_values(ts: Column) -> list[Column]:
    """Zero-padded ``year``, ``month`` and ``day`` strings (session zone must be UTC)."""
    return [
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
    ]


def batch_id(window_end: Column, window_id: Column) -> Column:
    """``batch_<ns>_<window>.json.gz``: a function of the data, so a retry yields the same id.

    Sorting ids as text sorts by time, then by window; ids are unique per device.
    """
    return F.format_string("batch_%019d_%010d.json.gz", F.unix_micros(window_end) * 1000, window_id)


def object_key(ts: Column, device_id: Column, batch: Column) -> Column:
    """``year=YYYY/month=MM/day=DD/device_id=ID/<batch id>``."""
    return F.concat(
        F.date_format(ts, "'year='yyyy'/month='MM'/day='dd'/device_id='"), device_id, F.lit("/"), batch
    )

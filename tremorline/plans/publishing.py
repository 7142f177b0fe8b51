"""From windows to the lake, and the view of what is still queued."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.functions.payload import window_payloads
from tremorline.operators.backlog import dedupe_redelivery, fifo_order, pending_batches
from tremorline.session import cut_lineage
from tremorline.sources.archive import BATCH_PATTERN, audit_archive, fill_missing_time, split_quarantine, with_device
from tremorline.sources.lake import read_lake, to_lake_rows, write_lake


def publish(windows: DataFrame, path: str) -> DataFrame:
    """Write detected windows to the lake, once however often it is done; returns the lake as readers see it."""
    write_lake(window_payloads(windows), path)
    return read_lake(windows.sparkSession, path)


def archive_batches(windows: DataFrame, path: str, mode: str = "append", max_records: int = 100_000) -> None:
    """Queue detected windows as gzip JSON lines; many windows per file, the batch id in the record.

    ``max_records`` bounds the size of a file, which the audit decodes as a whole.
    """
    (
        window_payloads(windows)
        .drop("window_id", "window_end")
        .write.mode(mode)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_records)
        .json(path)
    )


def backlog(
    spark: SparkSession,
    archive_path: str,
    lake: DataFrame,
    pattern: str = BATCH_PATTERN,
    device_id: str | None = None,
    date_undated: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(readable batches not yet in the lake, with their queue position; unreadable ones).

    ``device_id`` names the device of records that carry none, ``date_undated`` dates records without a time by when their
    file was written. The archive is decoded once and kept; of the lake only the days of the archive are read. Positions
    follow the ids as text, like ``peek_oldest``, whoever made them.
    """
    audited = audit_archive(spark, archive_path, pattern)
    audited = cut_lineage(with_device(fill_missing_time(audited) if date_undated else audited, device_id))
    good, bad = split_quarantine(audited)
    days = to_lake_rows(good).agg(*[f(F.concat("year", "month", "day")) for f in (F.min, F.max)]).first()
    if days[0] is not None:
        lake = lake.where(F.concat("year", "month", "day").between(days[0], days[1]))
    waiting = pending_batches(dedupe_redelivery(good), lake)
    return fifo_order(waiting), bad

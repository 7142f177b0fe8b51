"""Streaming hand-off: windows to an archive, archive to lake and quarantine, running metrics.

Each query names a checkpoint folder. File sinks commit every micro-batch to a log in the output folder, so
a restart neither loses nor repeats a batch for readers that go through Spark. Folders that batch jobs write as well, the
archive and the lake, are written micro-batch by micro-batch without such a log, which would hide their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tremorline.operators.detect import classification_metrics, confusion_counts
from tremorline.plans.publishing import archive_batches
from tremorline.sources.archive import BATCH_PATTERN, decode_files, fill_missing_time, split_quarantine, with_device
from tremorline.sources.lake import BINARY_FILE_SCHEMA, MANY_FILES, compact_lake, write_lake

def _start(df: DataFrame, fmt: str, path: str, checkpoint: str, interval: str | None, **options) -> StreamingQuery:
    """Drain what is there and stop, or with ``interval`` keep polling."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        df.writeStream.format(fmt)
        .options(**options)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def write_windows(windows: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Keep a stream of windows as a Parquet table."""
    return _start(windows, "parquet", path, checkpoint, interval)


LATE = ["late_ts", "late_seq", "late_acceleration", "late_ground_truth"]


def write_ordered_windows(
    rows: DataFrame, path: str, late_path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep the windows of ``stream_count_windows_in_order`` as one Parquet table and the late samples as another.

    Each micro-batch has a folder of its own in both, which it replaces when it is repeated.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        windows, late = batch.where("late_ts IS NULL").drop(*LATE), batch.where("late_ts IS NOT NULL")
        windows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        renamed = [F.col(c).alias(c.removeprefix("late_")) for c in LATE]
        late.select("device_id", *renamed).write.mode("overwrite").parquet(f"{late_path}/epoch={epoch}")
        batch.unpersist()

    return _each_batch(rows, write, checkpoint, interval)


def _each_batch(df: DataFrame, write, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Hand every micro-batch to ``write``; drain what is there and stop, or with ``interval`` keep polling."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def queue_windows(windows: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append a stream of detected windows to an archive of gzip JSON batches.

    The folder may be shared with ``archive_batches``. A micro-batch that is repeated after a failure queues its batches
    twice; their ids are the same, and publishing takes each once.
    """

    def append(batch: DataFrame, _: int) -> None:
        archive_batches(batch, path)

    return _each_batch(windows, append, checkpoint, interval)


def stream_archive(
    spark: SparkSession, path: str, pattern: str = BATCH_PATTERN, max_files: int = 1000
) -> DataFrame:
    """Decode finished batch files as they arrive, broken ones included."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
    )
    return decode_files(files.select("path", "modificationTime", "content"))


def sync_to_lake(
    archive: DataFrame,
    path: str,
    checkpoint: str,
    device_id: str | None = None,
    interval: str | None = None,
    date_undated: bool = False,
    compact_every: int = 64,
    quarantine_path: str | None = None,
) -> StreamingQuery:
    """Publish the readable records of an archive stream to the lake, each batch once however often it is delivered.

    ``device_id`` names the device of records that carry none, ``date_undated`` dates records without a time by when their
    file was written. Micro-batches are merged into the lake (see ``write_lake``), which batch jobs may write as well: a micro-batch
    appends what is new. Every ``compact_every`` micro-batches folders of very many files are put together. With
    ``quarantine_path`` the unreadable records go there, one folder per micro-batch, and the archive is decoded once for both.
    """
    audited = fill_missing_time(archive) if date_undated else archive

    def merge(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist() if quarantine_path else batch
        good, bad = split_quarantine(batch)
        write_lake(with_device(good, device_id), path, owner=checkpoint)
        if quarantine_path:
            bad.write.mode("overwrite").parquet(f"{quarantine_path}/epoch={epoch}")
            batch.unpersist()
        if compact_every and (epoch + 1) % compact_every == 0:
            compact_lake(batch.sparkSession, path, MANY_FILES, owner=checkpoint)

    return _each_batch(audited, merge, checkpoint, interval)


def quarantine(archive: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Set the unreadable records of an archive stream aside, with the reason."""
    _, bad = split_quarantine(archive)
    return _start(bad, "parquet", path, checkpoint, interval)


def dedupe_stream(batches: DataFrame, lateness: str) -> DataFrame:
    """Drop redelivered batches within ``lateness`` of the first; needs an ``event_ts`` column."""
    return batches.withWatermark("event_ts", lateness).dropDuplicatesWithinWatermark(["device_id", "batch_id"])


def running_metrics(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    by: list[str] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the metrics of all windows seen so far at ``path``.

    Every micro-batch replaces the table, so a repeated one leaves the same result. ``windows`` must be a
    stream of finished windows (a table written by ``write_windows``).
    """

    def replace(metrics: DataFrame, _: int) -> None:
        # One row without keys; with keys as many files as the aggregation has partitions.
        (metrics if by else metrics.coalesce(1)).write.mode("overwrite").parquet(path)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        classification_metrics(confusion_counts(windows, by))
        .writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )

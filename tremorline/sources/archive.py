"""Archives of gzip-compressed JSON batches: clean scan, and audit with quarantine."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorline.functions.keys import epoch_seconds, utc_timestamp
from tremorline.functions.payload import CORRUPT, decode_payload
from tremorline.model import PAYLOAD_SCHEMA
from tremorline.sources.archive_files import ArchiveFolder, read_lines

# Fixed value: the name pattern of finished batches. Files still being written end in ".tmp".
SINGLE_PATTERN = "batch_*.json.gz"
# Those, and the files of many batches that ``archive_batches`` and ``queue_windows`` write.
BATCH_PATTERN = "{batch_,part-}*.json.gz"

BATCH_FIELDS = T.StructType(
    [T.StructField("device_id", T.StringType()), T.StructField("batch_id", T.StringType())]
    + PAYLOAD_SCHEMA.fields
)

LINES = T.StructType(
    [T.StructField("file_name", T.StringType()), T.StructField("ingested", T.DoubleType())]
    + [T.StructField(name, T.StringType()) for name in ("record", "_reason")]
)
NO_TIMESTAMP = "no timestamp"


def read_archive(
    spark: SparkSession, path: str, pattern: str = BATCH_PATTERN, device_id: str | None = None
) -> DataFrame:
    """Scan the finished batches of an archive whose files are known to be readable, but for subfolders.

    ``device_id`` names the device of records that carry none.

    ``_corrupt_record`` holds text that is not JSON. The batch id is the one in the record, else the name
    of the file. A file that is not gzip fails the job; use ``audit_archive`` where that may happen.
    """
    schema = T.StructType(BATCH_FIELDS.fields + [T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(schema)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", pattern)
        .json(path)
    )
    named = rows.withColumn("batch_id", F.coalesce("batch_id", F.col("_metadata.file_name")))
    return with_device(named, device_id)


def with_device(batches: DataFrame, device_id: str | None) -> DataFrame:
    """Name the device of records that carry none."""
    if device_id is None:
        return batches
    return batches.withColumn("device_id", F.coalesce("device_id", F.lit(device_id)))


def explode_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One output row per line, in pieces; a file is read to its end first, as a damaged end condemns all of it."""
    for batch in batches:
        for name, ingested, body in zip(*(batch[c] for c in ("file_name", "ingested", "content"))):
            content = body.as_py()
            for lines, reason in read_lines(lambda content=content: io.BytesIO(content)):
                n = len(lines)
                columns = [
                    pa.array([name.as_py()] * n, pa.string()),
                    pa.array([ingested.as_py()] * n, pa.float64()),
                    pa.array(lines, pa.string()),
                    pa.array([reason] * n, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=LINES.names)


def classify_record(text: Column, parsed: Column) -> Column:
    """Why a decoded record cannot be published, or null if it can."""
    # Bare NaN is accepted in a payload but not by try_parse_json, so that only names what failed already.
    is_json = F.try_parse_json(text).isNotNull()
    return (
        F.when(~F.ltrim(text).startswith("{"), F.when(is_json, "not an object").otherwise("not json"))
        .when(parsed.isNull(), "not json")
        .when(parsed[CORRUPT].isNotNull(), F.when(is_json, "wrong type").otherwise("not json"))
        .when(F.regexp_like(text, F.lit(r"^\s*\{\s*\}\s*$")), "no fields")
        .when(parsed["timestamp"].isNull() | F.isnan(parsed["timestamp"]), NO_TIMESTAMP)
    )


def decode_files(files: DataFrame) -> DataFrame:
    """Decode ``binaryFile`` rows into one row per JSON line.

    Columns: ``file_name``, ``ingested`` (Unix seconds at which the file was written), ``record`` (the text,
    null if the body has none), ``reason`` (null for a record that can be published) and the batch fields.
    Works on static and streaming frames.
    """
    named = files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        epoch_seconds(F.col("modificationTime")).alias("ingested"),
        "content",
    )
    lines = named.mapInArrow(explode_files, LINES)
    # A part without rows is how Spark's own writer leaves an empty partition; a batch without rows is broken.
    own = (F.col("_reason") == "empty") & F.col("file_name").startswith("part-")
    return parse_records(lines.where(~F.coalesce(own, F.lit(False))), F.col("_reason"))


def parse_records(lines: DataFrame, body_reason: Column | None = None) -> DataFrame:
    """Parse a ``record`` text column and say what is wrong with it, if anything."""
    body_reason = F.lit(None).cast("string") if body_reason is None else body_reason
    kept = [c for c in lines.columns if c not in ("record", "_reason")]
    parsed = F.col("_parsed")
    decoded = lines.withColumn("_parsed", decode_payload(F.col("record"), BATCH_FIELDS))
    name = F.col("file_name") if "file_name" in kept else F.lit(None).cast("string")
    return decoded.select(
        *kept,
        "record",
        F.coalesce(body_reason, classify_record(F.col("record"), parsed)).alias("reason"),
        parsed["device_id"].alias("device_id"),
        F.coalesce(parsed["batch_id"], name).alias("batch_id"),
        *[parsed[f.name].alias(f.name) for f in PAYLOAD_SCHEMA.fields],
    )


def audit_archive(spark: SparkSession, path: str, pattern: str = BATCH_PATTERN) -> DataFrame:
    """Decode every finished batch file, broken ones included, one file body per row.

    Files in quarantine subfolders are not looked at. Zero-byte files are not delivered by Spark's file
    sources; ``missing_batches`` finds them by name.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return decode_files(files.select("path", "modificationTime", "content"))


def audit_archive_folder(spark: SparkSession, path: str, pattern: str = SINGLE_PATTERN) -> DataFrame:
    """As ``audit_archive``, for one folder that this package lists itself: zero-byte files have a row and a reason as well.

    Files still being written and files in subfolders are not looked at. Batch only.
    """
    spark.dataSource.register(ArchiveFolder)
    lines = spark.read.format(ArchiveFolder.name()).option("pattern", pattern).load(path)
    return parse_records(lines, F.col("_reason"))


def fill_missing_time(audited: DataFrame) -> DataFrame:
    """Date records without a timestamp by when their file was written, instead of setting them aside.

    Unlike the time of processing, that is the same however often a file is delivered.
    """
    undated = F.coalesce(F.col("reason") == NO_TIMESTAMP, F.lit(False))
    return audited.withColumn(
        "timestamp", F.when(undated, F.col("ingested")).otherwise(F.col("timestamp"))
    ).withColumn("reason", F.when(~undated, F.col("reason")))


def split_quarantine(audited: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that can be published, records or files to set aside with their reason)."""
    good = audited.where(F.col("reason").isNull()).drop("reason", "record", "ingested")
    bad = audited.where(F.col("reason").isNotNull()).select("file_name", "record", "reason")
    return good, bad


def missing_batches(expected: DataFrame, audited: DataFrame) -> DataFrame:
    """Expected file names of which the audit saw nothing: lost or zero-byte files."""
    return expected.select("file_name").join(audited.select("file_name").distinct(), "file_name", "left_anti")


def with_event_time(batches: DataFrame) -> DataFrame:
    """Add ``event_ts`` from the payload's Unix seconds."""
    return batches.withColumn("event_ts", utc_timestamp(F.col("timestamp")))

"""The published lake: gzip JSON under year/month/day/device_id folders."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorline.functions.keys import partition_values, utc_timestamp
from tremorline.model import LAKE_SCHEMA, PARTITION_COLUMNS, PAYLOAD_SCHEMA
from tremorline.operators.blocks import broadcast_if_small
from tremorline.session import new_folder
from tremorline.sources.lake_files import append_files, has_many_folders, is_local, list_files, read_files
from tremorline.sources.lake_index import LAKE_KEY, Folder, LakeBusy, LakeIndex, batch_key, content_hash

__all__ = ["LakeBusy", "compact_lake", "list_lake", "read_lake", "release_lake", "to_lake_rows", "write_lake"]


def to_lake_rows(batches: DataFrame) -> DataFrame:
    """Batch id, payload and partition values; partitions follow the payload's time in UTC."""
    ts = utc_timestamp(F.col("timestamp"))
    return batches.select(
        "batch_id", *[f.name for f in PAYLOAD_SCHEMA.fields], *partition_values(ts), "device_id"
    )


BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
#: A folder of so many files is put together when a stream comes to it.
MANY_FILES = 64
#: A task writes so many folders, and so many rows of one folder; opening a file costs more than the few rows in it.
FOLDERS_PER_TASK = 1024
ROWS_PER_TASK = 500_000
#: Folders are listed by so many tasks, from the first level of more than ``SERIAL`` folders: the days of a month, each by one task. Spark's
#: own settings are 10000 tasks, one for every folder, and 32, with which the driver looks at each device of each day.
LISTING_TASKS = 32
SERIAL = 12
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
THRESHOLD = "spark.sql.sources.parallelPartitionDiscovery.threshold"


def write_lake(
    batches: DataFrame,
    path: str,
    mode: str = "merge",
    max_records: int = 1_000_000,
    owner: str | None = None,
    wait: float = 60.0,
) -> None:
    """Write batches to the lake; each (day, device, batch) is there once, however often it is written.

    ``merge`` asks the lake's index which batches are there. New ones are appended, equal ones left out; no folder is read, so the
    cost follows what is new. A batch that is there with another content replaces it, and only for that its folder is read and
    written anew. ``append`` does not ask, for batches known to be new.

    One writer writes at a time; another one waits ``wait`` seconds and then fails with ``LakeBusy``. A writer that died leaves
    its lock; it is its own again under the same ``owner`` name, or freed by ``release_lake``. What it had written by then is found
    by the next writer.
    """
    if mode not in ("merge", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    spark, index = batches.sparkSession, LakeIndex(batches.sparkSession, path)
    with index.held(owner, wait), _Scratch(spark) as scratch:
        index.recover(lambda: _lake_if_any(spark, path))
        rows = to_lake_rows(batches)
        rows = (rows.dropDuplicates(LAKE_KEY) if mode == "merge" else rows).withColumns({"key": batch_key(), "content": content_hash()})
        fresh = scratch.keep(rows, "fresh")
        n_fresh = fresh.count()
        if not n_fresh:
            return
        if mode == "merge":
            judged = fresh.join(index.known(fresh, n_fresh), "key", "left").where("known IS NULL OR known <> content")
            fresh = scratch.keep(judged, "judged")
            if fresh.isEmpty():
                return
        version = index.state(fresh)
        if mode == "merge":
            changed = fresh.where("known IS NOT NULL")
            if not changed.isEmpty():
                folders = scratch.keep(_replaced(read_lake(spark, path), changed), "folders")
                _write_rows(folders, path, "overwrite", max_records)
            fresh = fresh.where("known IS NULL")
        _write_rows(fresh.select(*LAKE_SCHEMA.fieldNames()), path, "append", max_records)
        index.confirm(version)


def release_lake(spark: SparkSession, path: str) -> None:
    """Free a lake whose writer is gone."""
    LakeIndex(spark, path).folder.delete("lock")


def compact_lake(
    spark: SparkSession,
    path: str,
    min_files: int = 2,
    max_records: int = 1_000_000,
    owner: str | None = None,
    wait: float = 60.0,
) -> None:
    """Put the files of every folder that has at least ``min_files`` of them together. What the lake holds stays the same."""
    with LakeIndex(spark, path).held(owner, wait), _Scratch(spark) as scratch:
        crowded = list_lake(spark, path).where(F.col("n_files") >= min_files).select(*PARTITION_COLUMNS)
        crowded = scratch.keep(crowded, "crowded")
        if not crowded.isEmpty():
            lake = read_lake(spark, path)
            rows = lake.join(crowded, _same(lake, crowded, PARTITION_COLUMNS), "left_semi")
            _write_rows(scratch.keep(rows, "folders"), path, "overwrite", max_records)


class _Scratch:
    """Tables in the shared folder that go when the work is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> _Scratch:
        return self

    def keep(self, df: DataFrame, purpose: str) -> DataFrame:
        self.paths.append(new_folder(self.spark, purpose))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def __exit__(self, *_) -> None:
        for path in self.paths:
            Folder(self.spark, path).delete()


def _write_rows(rows: DataFrame, path: str, mode: str, max_records: int) -> None:
    """The rows of a folder come together in one task so that few files are written; a crowded folder is several tasks' work.

    ``rows`` are a stored table: its folders are counted first, as time goes by the number of files rather than bytes.
    """
    sizes = rows.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("_rows"))
    crowded = F.col("_rows") > ROWS_PER_TASK
    n_folders, n_rows, n_crowded = sizes.agg(F.count(F.lit(1)), F.sum("_rows"), F.count_if(crowded)).first()
    n_tasks = max(1, -(-n_folders // FOLDERS_PER_TASK), -(-(n_rows or 0) // ROWS_PER_TASK))
    keys = [F.col(c) for c in PARTITION_COLUMNS]
    if n_crowded:
        large = sizes.where(crowded).select(*[F.col(c).alias(f"_{c}") for c in PARTITION_COLUMNS], "_rows")
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PARTITION_COLUMNS])
        part = F.pmod(F.xxhash64("batch_id"), F.ceil(F.col("_rows") / ROWS_PER_TASK))
        rows = rows.join(broadcast_if_small(large, n_crowded), same, "left").withColumn("_part", F.coalesce(part, F.lit(0)))
        keys.append(F.col("_part"))
    rows = rows.repartition(n_tasks, *keys).select(*LAKE_SCHEMA.fieldNames())
    if mode == "append" and is_local(path):
        return append_files(rows, path, max_records)
    (
        rows.write.mode(mode)
        .partitionBy(*PARTITION_COLUMNS)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_records)
        .option("partitionOverwriteMode", "dynamic")
        .json(path)
    )


def _same(one: DataFrame, other: DataFrame, names: list[str]) -> Column:
    return reduce(and_, [one[c].eqNullSafe(other[c]) for c in names])


def _replaced(lake: DataFrame, changed: DataFrame) -> DataFrame:
    """The rows of the folders that ``changed`` touches, with those of ``changed`` in the place of what they replace."""
    folders, keys = changed.select(*PARTITION_COLUMNS).distinct(), changed.select(*LAKE_KEY)
    touched = lake.join(folders, _same(lake, folders, PARTITION_COLUMNS), "left_semi")
    kept = touched.join(keys, _same(touched, keys, LAKE_KEY), "left_anti")
    names = LAKE_SCHEMA.fieldNames()
    return kept.select(*names).unionByName(changed.select(*names))


def _lake_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """The lake, unless nothing was written to it yet."""
    return read_lake(spark, path) if any(n.startswith("year=") for n in Folder(spark, path).names()) else None


@contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    """Folders are listed in few tasks while this holds."""
    before = {name: spark.conf.get(name) for name in (LISTING, THRESHOLD)}
    for name, most in ((LISTING, LISTING_TASKS), (THRESHOLD, SERIAL)):
        spark.conf.set(name, min(int(before[name]), most))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def read_lake(spark: SparkSession, path: str, files: bool = False) -> DataFrame:
    """Read the lake; filters on the partition columns prune folders. With ``files`` each row has the ``file_path`` and ``file_size`` of its file.

    The schema is given, so ``month`` stays the text '07' and no file is opened to infer types. A lake of many folders in a local or
    mounted folder is listed and read by tasks (see ``lake_files``), and listed anew each time; others by Spark's reader, whose
    driver holds an entry for each file.
    """
    if has_many_folders(path):
        rows = read_files(spark, path)
        return rows if files else rows.drop("file_path", "file_size")
    with _listing(spark):
        rows = spark.read.schema(LAKE_SCHEMA).json(path)
    return rows.select("*", "_metadata.file_path", "_metadata.file_size") if files else rows


def list_lake(spark: SparkSession, path: str) -> DataFrame:
    """Number and total size of the files in every folder, without reading them."""
    if has_many_folders(path):
        files = list_files(spark, path).where(F.col("file").endswith(".json.gz"))
        return files.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    schema = T.StructType(
        BINARY_FILE_SCHEMA.fields + [T.StructField(name, T.StringType()) for name in PARTITION_COLUMNS]
    )
    with _listing(spark):
        files = spark.read.format("binaryFile").schema(schema).option("pathGlobFilter", "*.json.gz").load(path)
    return files.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))

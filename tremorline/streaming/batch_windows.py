"""Count windows on a stream in which one device may hold much of a micro-batch.

Per-device state lives in one task per device. Here each micro-batch goes through the batch operators
instead, which cut crowded devices into blocks, and the samples that unfinished windows need are carried to
the next micro-batch as a table in a shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tremorline.model import SAMPLE_SCHEMA
from tremorline.operators.blocks import number_rows
from tremorline.operators.features import extract_features

#: State is kept in so many folders by a hash of the device; a micro-batch reads those of its devices.
BUCKETS = 64
#: After so many micro-batches what they added is put together with what was there before.
COMPACT_EVERY = 32

TAIL = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in SAMPLE_SCHEMA.fields)}, epoch bigint, bucket int"
SEEN = "device_id string, seen bigint, epoch bigint, bucket int"


def _bucket(device: str = "device_id") -> Column:
    return F.pmod(F.xxhash64(device), F.lit(BUCKETS)).cast("int")


class _State:
    """What unfinished windows need: samples seen per device, and its last samples.

    Every micro-batch adds a folder with the devices that it has rows of, under its number. Every ``COMPACT_EVERY``
    micro-batches a base is made of the base before and of what was added since. Folders are written by the number of the
    micro-batch alone, so a repeated one reads what it read before and replaces its own result.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folders(self, table: str, schema: str, base: int, epoch: int) -> DataFrame:
        """The base and what micro-batches from it up to ``epoch`` added; micro-batch 0 has no base."""
        paths = [f"{self.path}/{table}/added={e}" for e in range(base, epoch)]
        paths += [f"{self.path}/{table}/base={base}"] if base else []
        parts = [self.spark.read.schema(schema).parquet(p) for p in paths]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def _latest(self, base: int, epoch: int, only: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        tail, seen = (self._folders(name, schema, base, epoch) for name, schema in (("tail", TAIL), ("seen", SEEN)))
        if only is not None:
            buckets = [r["bucket"] for r in only.select(_bucket().alias("bucket")).distinct().collect()]
            devices = only.select(F.col("device_id").alias("_only"))
            mine = F.col("device_id").eqNullSafe(F.col("_only"))
            tail, seen = (x.where(F.col("bucket").isin(buckets)).join(devices, mine, "left_semi") for x in (tail, seen))
        # The number of samples seen only grows, and so does the micro-batch that counted them.
        seen = seen.groupBy("device_id").agg(F.max("seen").alias("seen"), F.max("epoch").alias("epoch"))
        newest = seen.select(F.col("device_id").alias("_device"), F.col("epoch").alias("_epoch"))
        current = F.col("device_id").eqNullSafe(F.col("_device")) & (F.col("epoch") == F.col("_epoch"))
        return tail.join(newest, current, "left_semi"), seen

    def read(self, epoch: int, devices: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Samples carried over and the number seen, of the given devices, before micro-batch ``epoch``."""
        base = epoch // COMPACT_EVERY * COMPACT_EVERY
        if epoch == base and base:
            for name, rows in zip(("tail", "seen"), self._latest(base - COMPACT_EVERY, base), strict=True):
                self._write(rows, f"{name}/base={base}")
        return self._latest(base, epoch, devices)

    def add(self, epoch: int, tail: DataFrame, seen: DataFrame) -> None:
        self._write(seen.withColumn("epoch", F.lit(epoch).cast("bigint")), f"seen/added={epoch}")
        self._write(tail.withColumn("epoch", F.lit(epoch).cast("bigint")), f"tail/added={epoch}")

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.withColumn("bucket", _bucket()).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}")


def count_windows_by_batch(
    samples: DataFrame,
    size: int,
    path: str,
    state: str,
    checkpoint: str,
    hop: int | None = None,
    interval: str | None = None,
    block_rows: int | None = None,
) -> StreamingQuery:
    """Write the count windows of a sample stream below ``path``, one ``epoch`` folder per micro-batch.

    Same windows as ``stream_count_windows``. Writes replace their folder, so a repeated micro-batch leaves
    the same result. ``state`` has to be a shared folder; it holds the number of samples seen and fewer than
    ``size + 2 * hop`` samples of each device. A micro-batch reads and writes those of its own devices.
    """
    hop = size if hop is None else hop
    # Carried rows begin at a multiple of the hop, early enough for the next window to be complete.
    overlap = -(-max(0, size - hop) // hop) * hop

    def kept_from(seen: Column) -> Column:
        return F.greatest(F.lit(0).cast("bigint"), F.floor(seen / hop) * hop - overlap)

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        kept = _State(spark, f"{state}/kept")
        # Written down once, so that the steps below need not read the source again.
        batch.select(*SAMPLE_SCHEMA.fieldNames()).write.mode("overwrite").parquet(f"{state}/new/slot={epoch % 2}")
        new = spark.read.schema(SAMPLE_SCHEMA).parquet(f"{state}/new/slot={epoch % 2}")
        here = new.groupBy("device_id").agg(F.count(F.lit(1)).alias("_new"))
        tail, seen = kept.read(epoch, here)
        new.unionByName(tail.select(*SAMPLE_SCHEMA.fieldNames())).write.mode("overwrite").parquet(
            f"{state}/rows/slot={epoch % 2}"
        )
        rows = spark.read.schema(SAMPLE_SCHEMA).parquet(f"{state}/rows/slot={epoch % 2}")

        # Positions of a device's rows in this micro-batch are off by _base from those in the stream.
        before = F.coalesce(seen["seen"], F.lit(0).cast("bigint"))
        counts = here.join(seen, here["device_id"].eqNullSafe(seen["device_id"]), "left").select(
            here["device_id"].alias("_device"),
            before.alias("_before"),
            kept_from(before).alias("_base"),
            (before + F.col("_new")).alias("seen"),
        )
        counts.write.mode("overwrite").parquet(f"{state}/counts/slot={epoch % 2}")
        counts = spark.read.parquet(f"{state}/counts/slot={epoch % 2}")
        of_device = F.col("device_id").eqNullSafe(F.col("_device"))

        local = extract_features(rows, size, hop, block_rows).join(counts, of_device).drop("_device")
        windows = local.withColumn("window_id", F.expr(f"window_id + _base div {hop}"))
        fresh = windows.where((F.col("window_id") + 1) * hop > F.col("_before"))
        fresh.drop("_before", "_base", "seen").write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

        newest, _, _ = number_rows(rows, descending=True, first=overlap + hop, block_rows=block_rows)
        rest = newest.join(counts, of_device).where(F.col("pos") < F.col("seen") - kept_from(F.col("seen")))
        kept.add(
            epoch,
            rest.select(*SAMPLE_SCHEMA.fieldNames()),
            counts.select(F.col("_device").alias("device_id"), "seen"),
        )

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return samples.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**trigger).start()

"""Ground truth from fault schedules: is a sample's time inside a fault interval of its device?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremorline.operators.blocks import BLOCK_ROWS, BROADCAST_ROWS, join_cells, split_crowded_keys
from tremorline.session import cut_lineage

MAX_PIECES = 200_000
MAX_PIECES_PER_BUCKET = 64
BUCKET_SECONDS = 3600


def merge_intervals(faults: DataFrame) -> DataFrame:
    """Union of the closed intervals of each device, as intervals that do not touch.

    Sorts each device's intervals in one task; meant for schedules small enough to broadcast.
    """
    order = W.partitionBy("device_id").orderBy("start_ts", "end_ts")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    opens = F.coalesce(F.col("start_ts") > F.max("end_ts").over(before), F.lit(True))
    islands = faults.withColumn("_opens", opens.cast("int")).withColumn("_island", F.sum("_opens").over(order))
    return (
        islands.groupBy("device_id", "_island")
        .agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"))
        .drop("_island")
    )


def label_faults(
    samples: DataFrame,
    faults: DataFrame,
    max_pieces: int = MAX_PIECES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Set ``ground_truth``: true iff ``start_ts <= ts <= end_ts`` for some fault of the device.

    Intervals may overlap; one with a missing bound or device labels nothing. A schedule that stays below
    ``max_pieces`` once cut into hours, and below what may be broadcast at all however large ``max_pieces`` is, with few pieces in
    any hour, is broadcast and the samples are not shuffled. Any other schedule is laid over the samples in time order (see ``_label_by_sweep``).
    """
    valid = (
        faults.where("start_ts <= end_ts AND device_id IS NOT NULL")
        .groupBy(F.col("device_id").cast("string").alias("device_id"), "start_ts")
        .agg(F.max("end_ts").alias("end_ts"))
    )
    samples = samples.drop("ground_truth")
    hours = F.floor(F.unix_seconds("end_ts") / BUCKET_SECONDS) - F.floor(
        F.unix_seconds("start_ts") / BUCKET_SECONDS
    )
    n_pieces = valid.agg(F.coalesce(F.sum(hours + 1), F.lit(0))).first()[0]
    if n_pieces <= min(max_pieces, BROADCAST_ROWS):
        pieces = cut_lineage(_hourly_pieces(merge_intervals(valid)))
        crowded = pieces.groupBy("device_id", "_hour").count().where(F.col("count") > MAX_PIECES_PER_BUCKET)
        if crowded.isEmpty():
            return _label_by_hour(samples, pieces)
    return _label_by_sweep(samples, valid, block_rows)


def label_fault_stream(samples: DataFrame, faults: DataFrame, lateness: str, longest: str) -> DataFrame:
    """``label_faults`` where samples and faults arrive as streams, each at most ``lateness`` out of order.

    No fault is longer than ``longest``; a longer one counts up to that. A sample inside a fault is labelled when both have arrived, any
    other when the watermark says that no fault will come for it. A sample is given once however many faults
    overlap. State holds what is younger than ``lateness`` and ``longest``. Samples without a time, or later than ``lateness``, are left out.
    """
    valid = faults.where("start_ts <= end_ts AND device_id IS NOT NULL").select(
        F.col("device_id").cast("string").alias("_device"), F.col("start_ts").alias("_start"), F.col("end_ts").alias("_end")
    )
    timed, valid = samples.drop("ground_truth").withWatermark("ts", lateness), valid.withWatermark("_start", lateness)
    inside = F.expr(f"device_id = _device AND ts >= _start AND ts <= _start + interval {longest} AND ts <= _end")
    joined = timed.join(valid, inside, "left_outer").withColumn("ground_truth", F.col("_start").isNotNull())
    return joined.drop("_device", "_start", "_end").dropDuplicatesWithinWatermark(["device_id", "ts", "seq"])


def _hourly_pieces(merged: DataFrame) -> DataFrame:
    first, last = (F.floor(F.unix_seconds(c) / BUCKET_SECONDS) for c in ("start_ts", "end_ts"))
    return merged.withColumn("_hour", F.explode(F.sequence(first, last)))


def _label_by_hour(samples: DataFrame, pieces: DataFrame) -> DataFrame:
    # Merged intervals do not touch, so a sample meets at most one and is never repeated.
    hour = F.floor(F.unix_seconds("ts") / BUCKET_SECONDS)
    labelled = samples.withColumn("_hour", hour).alias("s").join(
        F.broadcast(pieces).alias("f"),
        F.expr("s.device_id = f.device_id and s._hour = f._hour and s.ts between f.start_ts and f.end_ts"),
        "left",
    )
    return labelled.select(
        *[f"s.{c}" for c in samples.columns], F.col("f.start_ts").isNotNull().alias("ground_truth")
    )


def _label_by_sweep(samples: DataFrame, faults: DataFrame, block_rows: int) -> DataFrame:
    """A sample is inside a fault iff the latest end among the faults begun by then is not before it.

    That is a running maximum over samples and fault starts in time order. Crowded devices are cut into
    cells and each cell begins with the maximum of the cells before it, so no device is one task's work
    and the cost does not depend on how the intervals overlap.
    """
    starts = faults.select("device_id", F.col("start_ts").alias("ts"), F.col("end_ts").alias("_until"))
    merged = samples.unionByName(starts, allowMissingColumns=True)
    split = split_crowded_keys(
        merged,
        "device_id",
        F.unix_micros("ts").cast("double"),
        F.col("seq").cast("double"),
        block_rows,
        max(1, block_rows // 2),
        extra=[F.max("_until").alias("_cell_until")],
    )
    keys = ["device_id"] if split is None else split.keys
    so_far = W.partitionBy(*keys).orderBy(F.asc("ts"), F.asc_nulls_first("seq"))
    so_far = so_far.rowsBetween(W.unboundedPreceding, W.currentRow)
    until = F.max("_until").over(so_far)
    if split is not None:
        earlier = W.partitionBy("device_id").orderBy(*keys[1:]).rowsBetween(W.unboundedPreceding, -1)
        carried = split.cells.select(*keys, F.max("_cell_until").over(earlier).alias("_carried"))
        merged = join_cells(split.rows, carried, split.n_cells, keys)
        until = F.greatest(until, F.col("_carried"))
    # Rows of the schedule carry an end; they leave once they have been counted.
    return (
        merged.withColumn("ground_truth", F.coalesce(F.col("ts") <= until, F.lit(False)))
        .where(F.col("_until").isNull())
        .select(*samples.columns, "ground_truth")
    )

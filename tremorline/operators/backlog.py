"""What is still waiting to be published, in which order, and what arrived twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremorline.operators.blocks import join_cells
from tremorline.session import cut_lineage

BATCH_KEY = ["device_id", "batch_id"]


def pending_batches(queued: DataFrame, synced: DataFrame) -> DataFrame:
    """Queued batches that are not among the synced ones; unknown synced ids have no effect.

    A missing device equals itself.
    """
    done = synced.select(*BATCH_KEY)
    same = [queued[c].eqNullSafe(done[c]) for c in BATCH_KEY]
    return queued.join(done, same[0] & same[1], "left_anti")


def dedupe_redelivery(batches: DataFrame, delivered: Column | None = None) -> DataFrame:
    """One row per (device, batch): the last delivered, or any of them if copies are alike.

    Copies are reduced in the map tasks, so a batch delivered very often is no heavy group.
    """
    if delivered is None:
        return batches.dropDuplicates(BATCH_KEY)
    rest = [c for c in batches.columns if c not in BATCH_KEY]
    newest = F.max_by(F.struct(*rest), delivered).alias("_newest")
    return batches.groupBy(*BATCH_KEY).agg(newest).select(*BATCH_KEY, "_newest.*")


def fifo_order(batches: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """Add ``queue_position`` (from 1) per device, oldest first: by batch id as text, whoever made the ids.

    A sort by samples: splitters drawn from devices and ids deal the rows into ranges, so that a crowded device is several
    tasks' work however alike its ids begin. A row's position is the number of rows of its device in the ranges before plus its
    number in its own. Every row is moved once to its range and kept; a missing id comes first. Copies of one id have
    positions of their own and stay in one range; ``dedupe_redelivery`` leaves one of them.
    """
    by = [batches[c] for c in BATCH_KEY]
    ranged = batches.repartitionByRange(*by) if n_ranges is None else batches.repartitionByRange(n_ranges, *by)
    ranged = cut_lineage(ranged.withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("device_id", "_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.partitionBy("device_id").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = cut_lineage(sizes.select("device_id", "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")))
    placed = join_cells(ranged, before, before.count(), ["device_id", "_range"])
    number = F.row_number().over(W.partitionBy("device_id", "_range").orderBy(F.asc_nulls_first("batch_id")))
    return placed.select(*batches.columns, (F.col("_before") + number).alias("queue_position"))


def peek_oldest(batches: DataFrame) -> DataFrame:
    """The oldest batch of every device."""
    rest = [c for c in batches.columns if c != "device_id"]
    oldest = F.min_by(F.struct(*rest), "batch_id").alias("_oldest")
    return batches.groupBy("device_id").agg(oldest).select("device_id", "_oldest.*")


def queue_depth(batches: DataFrame) -> DataFrame:
    """Number of batches per device."""
    return batches.groupBy("device_id").agg(F.count(F.lit(1)).alias("depth"))

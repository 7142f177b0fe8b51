"""Row-count and event-time windows over samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremorline.operators.blocks import number_rows, row_order
from tremorline.operators.newest import not_older
from tremorline.session import cut_lineage


def assign_count_windows(
    samples: DataFrame, size: int, hop: int | None = None, block_rows: int | None = None
) -> tuple[DataFrame, list[str]]:
    """Give every sample the count window(s) it belongs to.

    Window k (from 0) of a device is due when its ``(k+1) * hop``-th sample arrives and holds the last
    ``size`` samples up to it. The default ``hop = size`` yields windows side by side. Adds ``pos`` and
    ``window_id``; returns the columns to group by, which are such that grouping needs no second shuffle.
    A sample appears ``ceil(size / hop)`` times, but is repeated only after the shuffle.
    """
    hop = size if hop is None else hop
    numbered, keys, length = number_rows(samples, hop=hop, reach=max(0, size - hop), block_rows=block_rows)
    if hop == size:
        windowed = numbered.withColumn("window_id", F.floor(F.col("pos") / size))
        return windowed, [*keys, "window_id"]
    first_due = F.floor(F.col("pos") / hop)
    last_due = F.floor((F.col("pos") + size) / hop) - 1
    if "block" in keys:
        per_block = length // hop
        first_due = F.greatest(first_due, F.col("block") * per_block)
        last_due = F.least(last_due, F.col("block") * per_block + per_block - 1)
    windowed = (
        numbered.withColumn("_first", first_due)
        .withColumn("_last", last_due)
        .where("_first <= _last")
        .withColumn("window_id", F.explode(F.sequence("_first", "_last")))
        .drop("_first", "_last")
    )
    return windowed, [*keys, "window_id"]


def is_due(size: int, hop: int | None = None) -> Column:
    """Whether a group's last position completes its window: a trailing partial window never is."""
    hop = size if hop is None else hop
    return F.col("last_pos") + 1 == (F.col("window_id") + 1) * hop


def latest_n(samples: DataFrame, n: int, block_rows: int | None = None) -> DataFrame:
    """The last ``n`` samples of every device: what a buffer of ``n`` slots holds at the end.

    For small ``n`` Spark limits each device to ``n`` rows in every map task before the shuffle. Above the limit of that
    rewrite, tasks build and merge bounded summaries of their newest rows (``newest``), which tell how old a row may be; what
    is left, about ``n`` rows a device, is numbered from the end. Rows of equal time and number have one order on either way.
    """
    limit = int(samples.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= limit:
        newest_first = W.partitionBy("device_id").orderBy(*row_order(samples, "device_id", ("ts", "seq"), descending=True))
        ranked = samples.withColumn("_rank", F.row_number().over(newest_first))
        return ranked.where(F.col("_rank") <= n).drop("_rank")
    rest = cut_lineage(not_older(samples, n))
    numbered, _, _ = number_rows(rest, descending=True, first=n, block_rows=block_rows)
    return numbered.select(*samples.columns)


def buffer_depth(samples: DataFrame, capacity: int) -> DataFrame:
    """Filled slots of a buffer of ``capacity`` per device, and whether it is full."""
    depth = F.least(F.count(F.lit(1)), F.lit(capacity).cast("bigint"))
    return (
        samples.groupBy("device_id")
        .agg(depth.alias("depth"))
        .withColumn("is_full", F.col("depth") == capacity)
    )


def time_window(duration: str = "1 second") -> Column:
    """Event-time window, the stream-friendly form of a count window at a fixed sampling rate."""
    return F.window("ts", duration)

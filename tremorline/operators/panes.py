"""Hopping count windows put together from panes, so that no row is repeated.

A pane holds ``gcd(size, hop)`` rows that follow one another; every window is a run of ``size / gcd`` panes. Rows are
reduced to panes where the row numbers left them, and windows are merged from panes at a cost per pane that does
not depend on how far windows overlap: panes are cut into chunks as long as a window, a window reaches over two chunks at
most, and so is the end of one (what the panes from its first on come to) and the beginning of the next (what the
panes up to its last come to). Both are running merges; nothing is subtracted, so a NaN stays in the windows that hold it.

Deviations are summed around the mean of the first pane with readings of a running merge. As that pane is part of it, the
rounding error of the spread is at most about as many units in the last place as a window has panes, whatever the
readings' offset.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremorline.operators.blocks import number_rows

#: What is known of a run of panes: rows, readings, their sum and sum of squares, squared deviations, first and last time.
MERGED = ["n", "m", "total", "squares", "spread", "first_ts", "last_ts"]


def _panes(numbered: DataFrame, keys: list[str], length: int) -> DataFrame:
    reduced = numbered.groupBy(*keys, F.floor(F.col("pos") / length).alias("pane")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("acceleration").alias("m"),
        F.sum("acceleration").alias("total"),
        F.sum(F.col("acceleration") * F.col("acceleration")).alias("squares"),
        F.avg("acceleration").alias("centre"),
        F.var_pop("acceleration").alias("variance"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.max_by("ground_truth", "pos").alias("ground_truth"),
    )
    return reduced.withColumn("spread", F.col("variance") * F.col("m")).drop("variance")


def _running(panes: DataFrame, within: list[str], name: str, backwards: bool) -> DataFrame:
    """Add the struct ``name`` of all panes of a chunk up to this one, or from this one on."""
    order = F.col("pane").desc() if backwards else F.col("pane").asc()
    so_far = W.partitionBy(*within).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    off = F.col("centre") - F.col("_around")
    merged = panes.withColumn("_around", F.first("centre", ignorenulls=True).over(so_far)).select(
        *panes.columns,
        *[F.sum(c).over(so_far).alias(f"_{c}") for c in ("n", "m", "total", "squares", "spread")],
        F.sum(F.col("m") * off).over(so_far).alias("_off"),
        F.sum(F.col("m") * off * off).over(so_far).alias("_off2"),
        F.min("first_ts").over(so_far).alias("_first_ts"),
        F.max("last_ts").over(so_far).alias("_last_ts"),
    )
    spread = F.col("_spread") + F.col("_off2") - F.col("_off") * F.col("_off") / F.col("_m")
    parts = [spread.alias(c) if c == "spread" else F.col(f"_{c}").alias(c) for c in MERGED]
    return merged.select(*panes.columns, F.struct(*parts).alias(name))


def _joined(left: Column, right: Column) -> Column:
    """The merge of two runs; either may lack readings."""
    def both(name: str) -> Column:
        return F.coalesce(left[name] + right[name], left[name], right[name])

    apart = right["total"] / right["m"] - left["total"] / left["m"]
    between = apart * apart * left["m"] * right["m"] / (left["m"] + right["m"])
    spread = F.coalesce(left["spread"] + right["spread"] + between, left["spread"], right["spread"])
    return F.struct(
        *[both(c).alias(c) for c in ("n", "m", "total", "squares")],
        spread.alias("spread"),
        F.least(left["first_ts"], right["first_ts"]).alias("first_ts"),
        F.greatest(left["last_ts"], right["last_ts"]).alias("last_ts"),
    )


def hopping_window_features(samples: DataFrame, size: int, hop: int, block_rows: int | None = None) -> DataFrame:
    """Time-domain features of every due window of ``size`` samples at each ``hop``-th one, ``hop`` at most ``size``.

    One exchange of the rows, by device (and block); all merges keep that partitioning. The first windows of a device hold fewer
    samples, a trailing partial window is not given. Missing readings count as samples and enter no feature.
    """
    numbered, keys, length = number_rows(samples, hop=hop, reach=size - hop, block_rows=block_rows)
    pane = math.gcd(size, hop)
    run = size // pane
    panes = _panes(numbered, keys, pane).withColumn("_chunk", F.floor(F.col("pane") / run))
    chunk = [*keys, "_chunk"]
    panes = _running(_running(panes, chunk, "_end", backwards=True), chunk, "_begin", backwards=False)
    # The window's first pane lies ``run - 1`` panes back. Where it opens this pane's chunk, the beginning is all there is.
    in_order = W.partitionBy(*keys).orderBy("pane")
    opening = F.when(F.col("pane") % run != run - 1, F.lag("_end", run - 1).over(in_order)) if run > 1 else F.lit(None)
    windows = panes.withColumn("_opening", opening)
    ends = (F.col("pane") + 1) * pane
    due = (F.col("n") == pane) & (ends % hop == 0)
    if "block" in keys:
        due &= ends > F.col("block") * length
    begin, before = F.col("_begin"), F.col("_opening")
    merged = F.when(before.isNotNull(), _joined(before, begin)).otherwise(begin) if run > 1 else begin
    whole = windows.where(due).select("device_id", F.floor(ends / hop - 1).alias("window_id"), merged.alias("w"), "ground_truth")
    return whole.select(
        "device_id",
        "window_id",
        "w.n",
        F.expr("sqrt(w.squares / w.m)").alias("rms"),
        F.expr("w.total / w.m").alias("mean"),
        # Rounding may leave a tiny negative spread; NaN stays NaN.
        F.expr("sqrt(CASE WHEN w.spread < 0 THEN 0D ELSE w.spread END / w.m)").alias("std"),
        F.col("w.first_ts").alias("window_start"),
        F.col("w.last_ts").alias("window_end"),
        "ground_truth",
    )

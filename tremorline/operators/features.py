"""Window features: RMS, mean, population standard deviation, dominant frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremorline.functions.spectrum import dominant_bin, magnitude_spectrum
from tremorline.operators.blocks import broadcast_if_small, join_cells, number_rows
from tremorline.operators.long_transform import dominant_bins_of_long_windows, least_limit
from tremorline.operators.panes import hopping_window_features
from tremorline.operators.run_reducer import reduce_runs
from tremorline.operators.windows import assign_count_windows, is_due, time_window
from tremorline.session import cut_lineage

DEFAULT_RATE_HZ = 1000.0
#: Readings of an event-time window that one task transforms; longer windows are split.
WINDOW_ROWS = 1 << 20
FEATURES = ["rms", "mean", "std", "dominant_freq_hz"]


def time_domain_features(newest: str) -> list[Column]:
    """Mergeable aggregates of a window; ``newest`` is an expression that orders its samples in time."""
    return [
        F.expr(aggregate)
        for aggregate in (
            "count(*) AS n",
            "sqrt(avg(acceleration * acceleration)) AS rms",
            "avg(acceleration) AS mean",
            "stddev_pop(acceleration) AS std",
            "min(ts) AS window_start",
            "max(ts) AS window_end",
            f"max_by(ground_truth, {newest}) AS ground_truth",
        )
    ]


def sample_rate() -> Column:
    """Samples over the time from first to last; 1000 Hz where that time is zero.

    ``n`` samples span ``n - 1`` intervals, so the estimate is high by ``n / (n - 1)``. That is the
    definition the dominant frequency is specified with.
    """
    return F.expr(
        f"""CASE WHEN n > 1 AND window_end > window_start
            THEN n / ((unix_micros(window_end) - unix_micros(window_start)) / 1e6D)
            ELSE {DEFAULT_RATE_HZ}D END"""
    )


def bin_frequency(bin_column: str) -> Column:
    """Frequency in Hz of a bin of an ``n``-point transform at ``sample_rate_hz``."""
    return F.expr(f"{bin_column} * (1D / (n * (1D / sample_rate_hz)))")


def window_arrays() -> Column:
    """The window's readings in time order; at most one window per group is collected."""
    return F.expr("sort_array(collect_list(struct(pos, acceleration))).acceleration AS readings")


def count_window_aggregates(
    samples: DataFrame,
    size: int,
    hop: int | None = None,
    with_array: bool = True,
    block_rows: int | None = None,
) -> DataFrame:
    """One row per complete count window with its time-domain features and, if asked, its readings.

    Overlapping windows are merged from panes; only where their readings are asked for is a row repeated per window.
    """
    if hop is not None and hop < size and not with_array:
        return hopping_window_features(samples, size, hop, block_rows)
    windowed, keys = assign_count_windows(samples, size, hop, block_rows)
    aggregates = [*time_domain_features("pos"), F.max("pos").alias("last_pos")]
    if with_array:
        aggregates.append(window_arrays())
    due = windowed.groupBy(*keys).agg(*aggregates).where(is_due(size, hop))
    return due.drop("block", "last_pos")


def with_frequencies(windows: DataFrame) -> DataFrame:
    """Add ``sample_rate_hz`` and ``dominant_freq_hz`` to windows with a ``dominant_bin``."""
    return windows.withColumn("sample_rate_hz", sample_rate()).withColumn(
        "dominant_freq_hz", bin_frequency("dominant_bin")
    )


def extract_features(
    samples: DataFrame, size: int, hop: int | None = None, block_rows: int | None = None
) -> DataFrame:
    """All features of every complete count window: one shuffle, one sort, one pass over each device's run."""
    return with_frequencies(reduce_runs(samples, size, hop, block_rows))


def window_spectra(
    samples: DataFrame, size: int, hop: int | None = None, block_rows: int | None = None
) -> DataFrame:
    """Magnitude and frequency of every bin of every complete count window."""
    spectra = (
        count_window_aggregates(samples, size, hop, block_rows=block_rows)
        .withColumn("sample_rate_hz", sample_rate())
        .withColumn("_spectrum", magnitude_spectrum("readings"))
        .selectExpr("*", "posexplode(_spectrum) AS (bin, magnitude)")
    )
    return spectra.select(
        "device_id", "window_id", "bin", bin_frequency("bin").alias("frequency_hz"), "magnitude"
    )


def time_window_features(samples: DataFrame, duration: str = "1 second") -> DataFrame:
    """Time-domain features per device and event-time window; batch or streaming.

    All aggregates merge, so a crowded window is reduced in the map tasks. The spectrum is left to count
    windows, where the number of readings brought together is fixed.
    """
    # (ts, seq) as one number: a struct as ordering would force a sort of all rows before aggregating.
    newest = "cast(unix_micros(ts) AS decimal(20, 0)) * 18446744073709551616BD + seq"
    return (
        samples.groupBy("device_id", time_window(duration).alias("_window"))
        .agg(*time_domain_features(newest))
        .withColumn("sample_rate_hz", sample_rate())
        .withColumn("interval_start", F.col("_window.start"))
        .withColumn("interval_end", F.col("_window.end"))
        .drop("_window")
    )


def time_window_spectral_features(
    samples: DataFrame, duration: str = "1 second", window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """All features per device and event-time window, numbered from the epoch; batch or streaming.

    The readings of a window are brought together for its transform. In batch, windows of more than ``window_rows`` readings are
    not: their transform is split over tasks that hold arrays of at most so many numbers (see ``long_transform``). On a stream
    the state holds the readings of open windows, so choose ``duration`` by the sampling rate there. Readings of equal time are
    ordered by ``seq``.
    """
    newest = "cast(unix_micros(ts) AS decimal(20, 0)) * 18446744073709551616BD + seq"
    in_order = "sort_array(collect_list(struct(ts, seq, acceleration))).acceleration AS readings"
    timed = samples.withColumn("_window", time_window(duration))
    crowded = None
    if not samples.isStreaming:
        sizes = timed.groupBy("device_id", F.unix_micros("_window.start").alias("window_us")).agg(F.count(F.lit(1)).alias("n"))
        crowded = cut_lineage(sizes.where(F.col("n") > window_rows))
        crowded = None if crowded.isEmpty() else crowded
    small = timed
    if crowded is not None:
        timed = timed.withColumn("window_us", F.unix_micros("_window.start"))
        marks = crowded.select(F.col("device_id").alias("_device"), F.col("window_us").alias("_us"))
        marks = broadcast_if_small(marks, crowded.count())
        inside = F.col("device_id").eqNullSafe(F.col("_device")) & (F.col("window_us") == F.col("_us"))
        small, large = timed.join(marks, inside, "left_anti"), timed.join(marks, inside, "left_semi")
    windows = small.groupBy("device_id", "_window").agg(*time_domain_features(newest), F.expr(in_order))
    windows = windows.withColumn("dominant_bin", dominant_bin("readings")).drop("readings")
    if crowded is not None:
        windows = windows.unionByName(_long_windows(cut_lineage(large.drop("window_us")), crowded, newest, window_rows))
    windows = (
        windows.withColumn("interval_start", F.col("_window.start")).withColumn("interval_end", F.col("_window.end")).drop("_window")
    )
    length = F.unix_micros("interval_end") - F.unix_micros("interval_start")
    numbered = windows.withColumn("window_id", F.floor(F.unix_micros("interval_start") / length))
    return with_frequencies(numbered)


def _long_windows(samples: DataFrame, lengths: DataFrame, newest: str, limit: int) -> DataFrame:
    """Time-domain features and dominant bin of crowded windows; ``samples`` have a ``_window``."""
    features = cut_lineage(samples.groupBy("device_id", "_window").agg(*time_domain_features(newest)))
    numbered, _, _ = number_rows(samples.select("device_id", "ts", "seq", "acceleration", "_window"))
    # Windows follow one another on a device, so a reading's place in its window is off by the readings of those before.
    earlier = W.partitionBy("device_id").orderBy("window_us").rowsBetween(W.unboundedPreceding, -1)
    begin = lengths.select("device_id", "window_us", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_begin"))
    rows = numbered.withColumn("window_us", F.unix_micros("_window.start"))
    rows = join_cells(rows, begin, lengths.count(), ["device_id", "window_us"])
    rows = rows.select("device_id", "window_us", (F.col("pos") - F.col("_begin")).alias("pos"), "acceleration")
    # Where a reading is not a number no bin is, and the first one counts as the largest.
    plain = features.where(~F.isnan("rms") & (F.col("rms") < float("inf"))).select(
        "device_id", F.unix_micros("_window.start").alias("window_us"), "n"
    )
    found = dominant_bins_of_long_windows(rows, plain, least_limit(plain, limit)).withColumnRenamed("device_id", "_device")
    same = F.col("device_id").eqNullSafe(F.col("_device")) & (F.unix_micros("_window.start") == F.col("window_us"))
    joined = features.join(found, same, "left").withColumn("dominant_bin", F.coalesce("dominant_bin", F.lit(1)))
    return joined.drop("_device", "window_us")


def features_for_devices(
    devices: DataFrame, samples: DataFrame, size: int, hop: int | None = None, block_rows: int | None = None
) -> DataFrame:
    """Features of all count windows, plus a row of zeros for each listed device that has no window.

    A device has a window iff it has as many samples as the hop. That is counted from the samples, so no feature is kept to
    learn it, and only distinct devices are joined.
    """
    features = extract_features(samples, size, hop, block_rows)
    enough = samples.groupBy("device_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= (size if hop is None else hop))
    empty = devices.select("device_id").distinct().join(enough, "device_id", "left_anti")
    zeros = empty.select("device_id", *[F.lit(0.0).alias(name) for name in FEATURES])
    known = features.select("device_id", *[F.coalesce(name, F.lit(0.0)).alias(name) for name in FEATURES])
    return known.unionByName(zeros)

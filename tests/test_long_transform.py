"""Transforms split over tasks: the same bins as a transform of the whole window, with arrays of a bounded length."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import rows_of, samples
from tremorline.functions.spectrum import dominant_bins
from tremorline.operators import long_transform
from tremorline.operators.features import time_window_spectral_features
from tremorline.operators.long_transform import dominant_bins_of_long_windows


def readings(spark, windows):
    rows = [(device, us, i, float(v)) for (device, us), x in windows.items() for i, v in enumerate(x)]
    lengths = [(device, us, len(x)) for (device, us), x in windows.items()]
    frame = spark.createDataFrame(rows, "device_id string, window_us long, pos long, acceleration double")
    return frame, spark.createDataFrame(lengths, "device_id string, window_us long, n long")


@pytest.mark.parametrize("limit", [64, 1000, 1 << 20])
def test_bins_of_windows_of_any_length(spark, limit):
    """Lengths that are prime, powers of two, and in between; two windows of a device and a missing device."""
    rnd = np.random.default_rng(limit)
    windows = {}
    for i, n in enumerate((2, 3, 97, 128, 360, 509, 512, 900)):
        windows[("d" if i % 2 else None, i)] = rnd.normal(size=n) + 3 * np.sin(2 * np.pi * rnd.integers(1, n // 2 + 1) * np.arange(n) / n)
    got = dominant_bins_of_long_windows(*readings(spark, windows), limit)
    expected = [(d, us, int(dominant_bins(np.array([x]))[0])) for (d, us), x in windows.items()]
    assert rows_of(got, "device_id", "window_us", "dominant_bin") == sorted(expected, key=repr)


def test_no_array_is_longer_than_the_limit(spark):
    """What is exchanged comes in pieces whose number is the square of the number of classes."""
    frame, lengths = readings(spark, {("d", 0): np.arange(900.0)})
    shape = long_transform._shapes(lengths, 64).first()
    assert (shape.n_classes, shape.n_rows) == (32, 64)
    with pytest.raises(ValueError, match="64"):
        dominant_bins_of_long_windows(frame, lengths, 32)


def test_split_windows_equal_whole_ones(spark):
    """Crowded and other windows, readings that are not numbers, equal times, a missing device and time."""
    rnd = np.random.default_rng(4)
    values = [float(v) for v in rnd.normal(size=700)]
    frame = samples(spark, values, rate=100.0).unionByName(samples(spark, values[:50], rate=100.0, device="e"))
    nan = samples(spark, [float("nan") if i == 40 else v for i, v in enumerate(values)], rate=100.0, device="f")
    none = samples(spark, values[100:400], rate=100.0).withColumn("device_id", F.lit(None).cast("string"))
    lost = samples(spark, values[:5]).withColumn("ts", F.lit(None).cast("timestamp"))
    equal = samples(spark, values[:300], times=[i // 3 / 100 for i in range(300)], device="g")
    frame = frame.unionByName(nan).unionByName(none).unionByName(lost).unionByName(equal)
    names = ["device_id", "window_id", "n", "round(rms, 9)", "round(mean, 9)", "round(std, 9)", "dominant_bin", "ground_truth", "window_end"]
    whole, split = (rows_of(time_window_spectral_features(frame, "3 seconds", window_rows=n), *names) for n in (1 << 20, 64))
    assert repr(whole) == repr(split)
    assert sum(row[2] > 64 for row in whole) == 8 and sum(row[2] <= 64 for row in whole) == 1


def test_windows_beyond_the_square_of_the_limit(spark):
    """A window needs arrays of the root of its convolution's length at least; what is smaller stands as it is."""
    rnd = np.random.default_rng(5)
    frame = samples(spark, [float(v) for v in rnd.normal(size=900)], rate=100.0)
    names = ["device_id", "window_id", "n", "round(rms, 9)", "dominant_bin"]
    whole, split = (rows_of(time_window_spectral_features(frame, "20 seconds", window_rows=n), *names) for n in (1 << 20, 16))
    assert whole == split and max(row[2] for row in whole) == 900
    _, lengths = readings(spark, {("d", 0): np.arange(900.0)})
    assert long_transform.least_limit(lengths, 64) == 64 and long_transform.least_limit(lengths, 16) == 256

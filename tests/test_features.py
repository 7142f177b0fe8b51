import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from tests.helpers import at, expected_features, rows_of, samples
from tremorline.functions.spectrum import dominant_bins
from tremorline.operators.features import (
    count_window_aggregates,
    extract_features,
    features_for_devices,
    time_window_features,
    window_spectra,
)
from tremorline.sources.samples import to_samples


def test_sine_has_closed_form_features(spark):
    n, k, amplitude = 1000, 10, 3.0
    wave = amplitude * np.sin(2 * np.pi * k * np.arange(n) / n)
    row = extract_features(samples(spark, wave), n).first()
    assert row.n == n
    assert row["mean"] == pytest.approx(0.0, abs=1e-12)
    assert row.rms == pytest.approx(amplitude / math.sqrt(2), abs=1e-9)
    assert row["std"] == pytest.approx(amplitude / math.sqrt(2), abs=1e-9)
    assert row.dominant_bin == k
    assert row.sample_rate_hz == pytest.approx(1000 / 0.999)
    assert row.dominant_freq_hz == pytest.approx(k * (1000 / 0.999) / n)


def test_features_match_numpy_for_every_window(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(0, 2, 128)
    times = np.cumsum(rng.uniform(0.001, 0.01, 128)).round(6)
    frame = extract_features(samples(spark, values, times=list(times)), 32)
    got = {r.window_id: r for r in frame.collect()}
    assert sorted(got) == [0, 1, 2, 3]
    for w, row in got.items():
        part = slice(32 * w, 32 * w + 32)
        for name, value in expected_features(values[part], times[part]).items():
            assert row[name] == pytest.approx(value, rel=1e-9), (w, name)


@pytest.mark.parametrize(
    "values, bin_, hz",
    [([5.0], 0, 0.0), ([1.0, 4.0], 1, None), ([2.0] * 8, 1, None)],
)
def test_short_and_constant_windows(spark, values, bin_, hz):
    row = extract_features(samples(spark, values), len(values)).first()
    assert row.dominant_bin == bin_
    if hz is not None:
        assert row.dominant_freq_hz == hz


def test_missing_reading_makes_nan_features(spark):
    raw = samples(spark, [1.0, None, 2.0, 3.0])
    clean = to_samples(raw, "device_id", "ts", "acceleration", "seq", "ground_truth")
    row = extract_features(clean, 4).first()
    assert row.n == 4 and math.isnan(row.rms) and math.isnan(row["std"]) and row.dominant_bin == 1


def test_equal_times_fall_back_to_the_default_rate(spark):
    row = extract_features(samples(spark, [1, 5, 1, 5], times=[1.0] * 4), 4).first()
    assert row.sample_rate_hz == 1000.0
    assert row.dominant_freq_hz == 500.0


def test_truth_is_that_of_the_last_sample(spark):
    inside = [False] * 3 + [True] * 4 + [False] + [False] * 7 + [True]
    frame = count_window_aggregates(samples(spark, range(16), truth=inside), 8, with_array=False)
    assert rows_of(frame, "window_id", "ground_truth") == [(0, False), (1, True)]


def test_fault_at_five_seconds_labels_windows_five_and_six(spark):
    # 1 kHz scaled down to 20 Hz: one window per second, fault from 5 s to 7 s, both ends included.
    truth = [5.0 <= i / 20 <= 7.0 for i in range(200)]
    frame = count_window_aggregates(samples(spark, range(200), rate=20, truth=truth), 20, with_array=False)
    assert [r.window_id for r in frame.where("ground_truth").orderBy("window_id").collect()] == [5, 6]


def test_spectrum_lists_every_bin(spark):
    values = [1.0, 2.0, 4.0, 8.0, 3.0, 0.0]
    rows = window_spectra(samples(spark, values), 6).orderBy("bin").collect()
    assert [r.magnitude for r in rows] == pytest.approx(list(np.abs(np.fft.rfft(values))))
    assert rows[0].frequency_hz == 0.0
    assert rows[1].frequency_hz == pytest.approx((6 / 0.005) / 6)


def test_devices_without_windows_get_zeros(spark):
    devices = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "device_id string")
    frame = features_for_devices(devices, samples(spark, [3.0] * 4), 4)
    rows = {r.device_id: r for r in frame.collect()}
    assert rows["d1"].rms == 3.0
    assert tuple(rows["d2"])[1:] == (0.0, 0.0, 0.0, 0.0) == tuple(rows["d3"])[1:]


def test_one_second_windows_follow_the_clock(spark):
    frame = time_window_features(samples(spark, range(25), rate=10), "1 second")
    start = F.unix_seconds("interval_start").alias("start")
    first = int(at(0).timestamp())
    assert rows_of(frame, start, "n") == [(first, 10), (first + 1, 10), (first + 2, 5)]


def test_last_of_equal_times_is_the_highest_seq(spark):
    frame = samples(spark, [1, 2, 3], truth=[False, True, False], times=[0.5] * 3)
    assert time_window_features(frame.where("seq < 2")).first().ground_truth is True
    assert time_window_features(frame).first().ground_truth is False


def test_time_windows_aggregate_without_sorting(spark):
    plan = time_window_features(samples(spark, range(10)))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=40))
def test_dominant_bin_is_the_first_largest(values):
    matrix = np.array([values], dtype=float)
    spectrum = np.abs(np.fft.rfft(values))[1:]
    got = int(dominant_bins(matrix)[0])
    if not len(spectrum):
        assert got == 0
    else:
        assert spectrum[got - 1] == spectrum.max() and (spectrum[: got - 1] < spectrum.max()).all()


def test_grouping_reuses_the_numbering_shuffle(spark, sf_dir):
    from catalog import queries as q

    frame = extract_features(q.samples(spark, sf_dir), 16)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "props" not in plan
    evaluated = count_window_aggregates(q.samples(spark, sf_dir), 16, with_array=False)
    text = evaluated._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text

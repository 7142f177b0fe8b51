import math

import pytest

from pyspark.sql import functions as F
from tests.helpers import samples
from tremorline.operators.detect import (
    classification_metrics,
    confusion_class,
    confusion_counts,
    flag_anomalies,
    metrics_report,
)
from tremorline.plans.detection import detect, evaluate

NAN = float("nan")


@pytest.mark.parametrize(
    "rms, std, expected",
    [
        (1.2, 0.8, False),
        (3.0, 1.0, True),
        (1.5, 2.8, True),
        (4.1, 3.5, True),
        (1.0, None, False),
        (None, None, False),
        (2.5, 2.0, False),
        (NAN, NAN, False),
        (NAN, 2.1, True),
        (math.inf, 0.0, True),
    ],
)
def test_thresholds(spark, rms, std, expected):
    frame = spark.createDataFrame([(rms, std)], "rms double, std double")
    assert flag_anomalies(frame, 2.5, 2.0).first().anomaly_detected is expected


def test_features_that_are_not_there_breach_nothing(spark):
    frame = spark.createDataFrame([(1,)], "id int")
    assert flag_anomalies(frame).first().anomaly_detected is False


def test_default_thresholds(spark):
    frame = spark.createDataFrame([(2.0, 1.8), (2.01, 0.0), (0.0, 1.81)], "rms double, std double")
    assert [r.anomaly_detected for r in flag_anomalies(frame).collect()] == [False, True, True]


def _outcomes(spark, pairs):
    return spark.createDataFrame(pairs, "anomaly_detected boolean, ground_truth boolean")


def test_confusion_and_metrics(spark):
    frame = _outcomes(spark, [(True, True), (True, False), (False, True), (False, False), (False, False)])
    classes = frame.select(confusion_class(F.col("anomaly_detected"), F.col("ground_truth")).alias("c"))
    assert [r.c for r in classes.collect()] == ["TP", "FP", "FN", "TN", "TN"]
    row = classification_metrics(confusion_counts(frame)).first()
    assert (row.precision, row.recall, row.f1_score, row.accuracy, row.total_windows) == (0.5, 0.5, 0.5, 0.6, 5)
    report = metrics_report(classification_metrics(confusion_counts(frame))).first()
    assert report.precision == "50.00%"
    assert report.report == (
        "precision 50.00%, recall 50.00%, F1 50.00% over 5 windows: 1 hits, 1 false alarms, 1 missed, 2 quiet"
    )


def test_no_windows_score_zero(spark):
    row = classification_metrics(confusion_counts(_outcomes(spark, []))).first()
    assert (row.precision, row.recall, row.f1_score, row.accuracy, row.total_windows) == (0, 0, 0, 0, 0)


def test_rounding_comes_last(spark):
    pairs = [(True, True)] * 2 + [(True, False)] + [(False, True)] * 4
    row = classification_metrics(confusion_counts(_outcomes(spark, pairs))).first()
    assert row.precision == 0.6667 and row.recall == 0.3333
    assert row.f1_score_exact == pytest.approx(0.4444444444)
    assert row.f1_score == 0.4444


def test_metrics_per_device(spark):
    frame = spark.createDataFrame(
        [("a", True, True), ("b", True, False)], "device_id string, anomaly_detected boolean, ground_truth boolean"
    )
    rows = {r.device_id: r.precision for r in classification_metrics(confusion_counts(frame, ["device_id"])).collect()}
    assert rows == {"a": 1.0, "b": 0.0}


def test_pipeline_flags_the_loud_window(spark):
    values = [0.1, -0.1] * 8 + [5.0, -5.0] * 8
    truth = [False] * 16 + [True] * 16
    frame = detect(samples(spark, values, truth=truth), 16)
    got = {r.window_id: (r.anomaly_detected, r.ground_truth) for r in frame.collect()}
    assert got == {0: (False, False), 1: (True, True)}
    row = evaluate(samples(spark, values, truth=truth), 16).first()
    assert (row.precision, row.recall, row.accuracy, row.total_windows) == (1.0, 1.0, 1.0, 2)

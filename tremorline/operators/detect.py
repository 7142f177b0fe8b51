"""Threshold detection and its scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The default operating limits.
RMS_THRESHOLD = 2.0
STD_THRESHOLD = 1.8


def _breaches(feature: Column, threshold: float) -> Column:
    # A missing feature counts as 0.0. NaN sorts above every number in SQL but breaches nothing.
    value = F.coalesce(feature, F.lit(0.0))
    return (value > threshold) & ~F.isnan(value)


def is_anomalous(
    rms: Column, std: Column, rms_threshold: float = RMS_THRESHOLD, std_threshold: float = STD_THRESHOLD
) -> Column:
    """RMS or standard deviation above (not at) its threshold."""
    return _breaches(rms, rms_threshold) | _breaches(std, std_threshold)


def flag_anomalies(
    windows: DataFrame, rms_threshold: float = RMS_THRESHOLD, std_threshold: float = STD_THRESHOLD
) -> DataFrame:
    """Add ``anomaly_detected``; a feature column the frame does not have counts as missing."""
    rms, std = (F.col(c) if c in windows.columns else F.lit(None).cast("double") for c in ("rms", "std"))
    return windows.withColumn("anomaly_detected", is_anomalous(rms, std, rms_threshold, std_threshold))


def confusion_class(predicted: Column, actual: Column) -> Column:
    """TP, FP, FN or TN."""
    return F.when(predicted & actual, "TP").when(predicted, "FP").when(actual, "FN").otherwise("TN")


def confusion_counts(
    windows: DataFrame,
    by: list[str] | None = None,
    predicted: str = "anomaly_detected",
    actual: str = "ground_truth",
) -> DataFrame:
    """Counts of the four classes, in total or per group."""
    outcome = confusion_class(F.col(predicted), F.col(actual))
    names = {"TP": "true_positives", "FP": "false_positives", "FN": "false_negatives", "TN": "true_negatives"}
    return windows.groupBy(*(by or [])).agg(
        *[F.count_if(outcome == label).alias(name) for label, name in names.items()]
    )


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and accuracy, 0.0 where undefined, rounded to four places at the end.

    The ``*_exact`` columns hold the unrounded values. ``round`` takes halves away from zero.
    """
    tp, fp, fn, tn = (
        F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives")
    )
    p, r = F.col("precision_exact"), F.col("recall_exact")
    scored = (
        counts.withColumn("total_windows", tp + fp + fn + tn)
        .withColumn("precision_exact", _ratio(tp, tp + fp))
        .withColumn("recall_exact", _ratio(tp, tp + fn))
        .withColumn("f1_score_exact", _ratio(2 * p * r, p + r))
        .withColumn("accuracy_exact", _ratio(tp + tn, F.col("total_windows")))
    )
    for name in ("precision", "recall", "f1_score", "accuracy"):
        scored = scored.withColumn(name, F.round(f"{name}_exact", 4))
    return scored


def metrics_report(metrics: DataFrame) -> DataFrame:
    """Metrics as percent texts and one summary line."""

    def percent(name: str) -> Column:
        return F.format_string("%.2f%%", F.col(name) * 100)

    return metrics.select(
        percent("precision").alias("precision"),
        percent("recall").alias("recall"),
        percent("f1_score").alias("f1_score"),
        "total_windows",
        F.format_string(
            "precision %s, recall %s, F1 %s over %d windows: %d hits, %d false alarms, %d missed, %d quiet",
            percent("precision"),
            percent("recall"),
            percent("f1_score"),
            F.col("total_windows"),
            F.col("true_positives"),
            F.col("false_positives"),
            F.col("false_negatives"),
            F.col("true_negatives"),
        ).alias("report"),
    )

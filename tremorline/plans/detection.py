"""The detection pipeline: samples to one scored payload per window."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tremorline.operators.detect import (
    RMS_THRESHOLD,
    STD_THRESHOLD,
    classification_metrics,
    confusion_counts,
    flag_anomalies,
    metrics_report,
)
from tremorline.operators.features import (
    count_window_aggregates,
    extract_features,
    time_window_spectral_features,
)

# Fixed value: samples per window, one second at 1 kHz.
WINDOW_SIZE = 1000


def detect(
    samples: DataFrame,
    size: int = WINDOW_SIZE,
    hop: int | None = None,
    rms_threshold: float = RMS_THRESHOLD,
    std_threshold: float = STD_THRESHOLD,
    block_rows: int | None = None,
) -> DataFrame:
    """Count windows with all features and the detector's verdict."""
    return flag_anomalies(extract_features(samples, size, hop, block_rows), rms_threshold, std_threshold)


def detect_time_windows(
    samples: DataFrame,
    duration: str = "1 second",
    rms_threshold: float = RMS_THRESHOLD,
    std_threshold: float = STD_THRESHOLD,
) -> DataFrame:
    """Event-time windows with all features and the detector's verdict; they go on to payloads like count windows."""
    return flag_anomalies(time_window_spectral_features(samples, duration), rms_threshold, std_threshold)


def evaluate(
    samples: DataFrame,
    size: int = WINDOW_SIZE,
    rms_threshold: float = RMS_THRESHOLD,
    std_threshold: float = STD_THRESHOLD,
    by: list[str] | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Confusion counts and metrics of the detector.

    The verdict needs no spectrum, so windows are reduced without collecting their readings.
    """
    windows = count_window_aggregates(samples, size, with_array=False, block_rows=block_rows)
    flagged = flag_anomalies(windows, rms_threshold, std_threshold)
    return classification_metrics(confusion_counts(flagged, by))


def report(
    samples: DataFrame,
    size: int = WINDOW_SIZE,
    rms_threshold: float = RMS_THRESHOLD,
    std_threshold: float = STD_THRESHOLD,
) -> DataFrame:
    """The detector's one-row performance report."""
    return metrics_report(evaluate(samples, size, rms_threshold, std_threshold))

"""Event-time windows on a stream, with a watermark as the rule for late data."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tremorline.operators.detect import RMS_THRESHOLD, STD_THRESHOLD, flag_anomalies
from tremorline.operators.features import time_window_features, time_window_spectral_features


def stream_time_windows(samples: DataFrame, duration: str, lateness: str) -> DataFrame:
    """Time-domain features per device and event-time window.

    A window is emitted, once, when the watermark (latest time seen less ``lateness``) has passed its end.
    Samples within ``lateness`` of the latest always count; those that come after their window was emitted
    are dropped. State is one aggregate buffer per open window.
    """
    return time_window_features(samples.withWatermark("ts", lateness), duration)


def stream_detect_time_windows(
    samples: DataFrame,
    duration: str,
    lateness: str,
    rms_threshold: float = RMS_THRESHOLD,
    std_threshold: float = STD_THRESHOLD,
) -> DataFrame:
    """All features and the detector's verdict per device and event-time window, emitted as above.

    State holds the readings of open windows.
    """
    windows = time_window_spectral_features(samples.withWatermark("ts", lateness), duration)
    return flag_anomalies(windows, rms_threshold, std_threshold)

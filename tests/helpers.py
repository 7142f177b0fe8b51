"""Small sample tables and a plain NumPy account of what a window's features are."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tremorline.model import SAMPLE_SCHEMA

EPOCH = dt.datetime(2026, 7, 27, tzinfo=dt.timezone.utc)


def at(seconds: float) -> dt.datetime:
    return EPOCH + dt.timedelta(microseconds=round(seconds * 1e6))


def samples(spark, values, rate=1000.0, device="d1", truth=None, times=None):
    rows = [
        (device, at(times[i] if times else i / rate), i, None if v is None else float(v),
         bool(truth[i]) if truth is not None else False)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, SAMPLE_SCHEMA)


def rows_of(df, *columns):
    picked = [F.expr(c) if isinstance(c, str) else c for c in columns]
    return sorted((tuple(r) for r in df.select(*picked).collect()), key=repr)


def expected_features(values, times):
    x = np.asarray(values, dtype=float)
    n = len(x)
    span = times[-1] - times[0]
    rate = n / span if n > 1 and span > 0 else 1000.0
    magnitudes = np.abs(np.fft.rfft(x))
    k = int(np.argmax(magnitudes[1:])) + 1 if len(magnitudes) > 1 else 0
    return {
        "rms": float(np.sqrt(np.mean(x * x))),
        "mean": float(np.mean(x)),
        "std": float(np.std(x)),
        "dominant_freq_hz": k * (1.0 / (n * (1.0 / rate))),
    }

"""Fourier transform of window arrays: the one part of a window's features SQL has no function for.

Both functions take whole Arrow batches. Windows of equal length are stacked into a matrix and
transformed with a single ``rfft`` call, so the cost per window is a row of a vectorised call.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf


def stacked_windows(windows: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yield (row numbers, matrix) for every window length found in a list array."""
    lengths = windows.value_lengths().to_numpy(zero_copy_only=False)
    values = windows.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        if len(rows) == len(lengths):
            yield rows, values.reshape(len(rows), int(length))
        else:
            yield rows, values[starts[rows][:, None] + np.arange(length)]


def magnitudes(matrix: np.ndarray) -> np.ndarray:
    """|rfft| of every row."""
    return np.abs(np.fft.rfft(matrix, axis=1))


def dominant_bins(matrix: np.ndarray) -> np.ndarray:
    """Index of the largest bin above DC per row; the lowest wins a tie, 0 if there is none."""
    if matrix.shape[1] < 2:
        return np.zeros(len(matrix), dtype=np.int32)
    return (np.argmax(magnitudes(matrix)[:, 1:], axis=1) + 1).astype(np.int32)


@arrow_udf(T.IntegerType())
def dominant_bin(windows: pa.Array) -> pa.Array:
    bins = np.zeros(len(windows), dtype=np.int32)
    for rows, matrix in stacked_windows(windows):
        bins[rows] = dominant_bins(matrix)
    return pa.array(bins)


@arrow_udf(T.ArrayType(T.DoubleType()))
def magnitude_spectrum(windows: pa.Array) -> pa.Array:
    spectra: list[np.ndarray] = [np.empty(0)] * len(windows)
    for rows, matrix in stacked_windows(windows):
        if matrix.shape[1]:
            for row, spectrum in zip(rows, magnitudes(matrix)):
                spectra[row] = spectrum
    return pa.array(spectra, type=pa.list_(pa.float64()))

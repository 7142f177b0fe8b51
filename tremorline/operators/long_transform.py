"""The dominant bin of windows that are too long for one task.

The transform of ``n`` readings, for any ``n``, is a convolution with a chirp, and a convolution is three transforms of a power of
two ``N >= 2n``. Each of these is split by residue class (decimation in time): with ``N = classes * rows``, the readings whose position
is ``r`` modulo ``classes`` are transformed on their own, multiplied with twiddle factors, and brought together per range of
frequencies for short transforms across the classes. So the work takes two exchanges of ``N`` numbers,
and no task holds an array of more than ``limit`` of them:

1. by class of position: chirped readings, and the chirp itself, transformed along the class;
2. by range of frequencies: both transformed across the classes, multiplied, and transformed back across them;
3. by class of the result: transformed back along the class, which yields every ``classes``-th bin.

What is left of a window is the largest of its bins in each class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "device_id string, window_us bigint"
SHAPE = ["n", "n_classes", "n_rows"]


def _shapes(lengths: DataFrame, limit: int) -> DataFrame:
    """How a window of ``n`` readings is cut: classes times the rows of a class is a power of two that holds its convolution."""
    bits, most = F.length(F.bin(2 * F.col("n") - 1)), limit.bit_length() - 1
    longest = lengths.agg(F.max("n")).first()[0] or 0
    if (2 * longest).bit_length() > 2 * most:
        raise ValueError(f"windows of {longest} readings need a limit of at least {1 << -(-(2 * longest).bit_length() // 2)}")
    one, rows = F.lit(1).cast("bigint"), F.least(bits, F.lit(most))
    return lengths.select(
        "device_id", "window_us", "n", F.call_function("shiftleft", one, bits - rows).alias("n_classes"),
        F.call_function("shiftleft", one, rows).alias("n_rows"),
    )


def least_limit(lengths: DataFrame, limit: int) -> int:
    """``limit``, or what the longest window needs if that is more: arrays of four times the root of its convolution's length.

    At the root itself every number that is exchanged would be a row of its own; so a row holds sixteen at least.
    """
    bits = (2 * (lengths.agg(F.max("n")).first()[0] or 0)).bit_length()
    return limit if bits <= 2 * (limit.bit_length() - 1) else 1 << (-(-bits // 2) + 2)


def _turns(part: np.ndarray, whole: int, sign: int) -> np.ndarray:
    """exp(sign * 2 pi i part / whole); part is reduced as a whole number first, so large ones lose nothing."""
    return np.exp(sign * 2j * np.pi * (part % whole) / whole)


def _chirp(j: np.ndarray, n: int) -> np.ndarray:
    return _turns(j * j, 2 * n, -1).conj()


def _key(table: pa.Table, rows: int) -> list[pa.Array]:
    first = table.slice(0, 1)
    return [pa.concat_arrays([first.column(c).combine_chunks()] * rows) for c in ("device_id", "window_us")]


def _shape(table: pa.Table) -> tuple[int, int, int]:
    return tuple(table.column(c)[0].as_py() for c in SHAPE)


def _along(table: pa.Table) -> pa.Table:
    """One class of a window's readings: transformed, in ranges of frequencies."""
    n, n_classes, n_rows = _shape(table)
    own = table.column("class")[0].as_py()
    position = table.column("pos").to_numpy()
    readings, chirp = np.zeros((2, n_rows), complex)
    readings[position // n_classes] = table.column("acceleration").to_numpy() * _chirp(position, n).conj()
    # The chirp is as long on either side of zero; positions below zero are at the end.
    at = own + n_classes * np.arange(n_rows, dtype=np.int64)
    total = n_classes * n_rows
    near = np.minimum(at, total - at)
    chirp[near < n] = _chirp(near[near < n], n)
    twiddle = _turns(own * np.arange(n_rows, dtype=np.int64), total, -1)
    a, b = np.fft.fft(readings) * twiddle, np.fft.fft(chirp) * twiddle
    per_range = n_rows // n_classes
    pieces = [[x[i * per_range : (i + 1) * per_range].tobytes() for i in range(n_classes)] for x in (a, b)]
    same = [pa.array([v] * n_classes, pa.int64()) for v in (n, n_classes, n_rows, own)]
    return pa.table(
        [*_key(table, n_classes), *same, pa.array(range(n_classes), pa.int64()), *(pa.array(p, pa.binary()) for p in pieces)],
        names=["device_id", "window_us", *SHAPE, "class", "range", "readings", "chirp"],
    )


def _across(table: pa.Table) -> pa.Table:
    """One range of frequencies of all classes: the product of both transforms, transformed back across the classes."""
    n, n_classes, n_rows = _shape(table)
    own, order = table.column("range")[0].as_py(), np.argsort(table.column("class").to_numpy())
    a, b = (
        np.fft.fft(np.stack([np.frombuffer(x, complex) for x in table.column(c).to_pylist()])[order], axis=0)
        for c in ("readings", "chirp")
    )
    back = np.fft.ifft(a * b, axis=0)
    frequency = own * back.shape[1] + np.arange(back.shape[1], dtype=np.int64)
    back *= _turns(np.arange(n_classes, dtype=np.int64)[:, None] * frequency, n_classes * n_rows, 1)
    same = [pa.array([v] * n_classes, pa.int64()) for v in (n, n_classes, n_rows)]
    return pa.table(
        [*_key(table, n_classes), *same, pa.array(range(n_classes), pa.int64()), pa.array([own] * n_classes, pa.int64()),
         pa.array([x.tobytes() for x in back], pa.binary())],
        names=["device_id", "window_us", *SHAPE, "class", "range", "readings"],
    )


def _largest(table: pa.Table) -> pa.Table:
    """One class of the result: its largest bin above DC, the first of equal ones."""
    n, n_classes, n_rows = _shape(table)
    own, order = table.column("class")[0].as_py(), np.argsort(table.column("range").to_numpy())
    pieces = table.column("readings").to_pylist()
    values = np.abs(np.fft.ifft(np.concatenate([np.frombuffer(pieces[i], complex) for i in order])))
    bins = own + n_classes * np.arange(n_rows, dtype=np.int64)
    wanted = (bins >= 1) & (bins <= n // 2)
    if not wanted.any():
        return table.schema.empty_table().select(["device_id", "window_us"]).append_column(
            "magnitude", pa.array([], pa.float64())).append_column("bin", pa.array([], pa.int64()))
    values, bins = values[wanted], bins[wanted]
    best = int(np.argmax(values))
    return pa.table(
        [*_key(table, 1), pa.array([values[best]]), pa.array([bins[best]])], names=["device_id", "window_us", "magnitude", "bin"]
    )


def dominant_bins_of_long_windows(readings: DataFrame, lengths: DataFrame, limit: int) -> DataFrame:
    """(device_id, window_us, dominant_bin) of windows (``lengths``: device_id, window_us, n >= 2).

    ``readings`` are device_id, window_us, pos (from 0 in time order) and acceleration, none of them missing or infinite. ``limit``
    bounds the arrays that a task holds; bins that differ by less than rounding count as equal only if they are.
    """
    shapes = _shapes(lengths, limit)
    same = readings["device_id"].eqNullSafe(shapes["device_id"]) & (readings["window_us"] == shapes["window_us"])
    rows = readings.join(shapes, same).select(
        readings["device_id"], readings["window_us"], *SHAPE, (F.col("pos") % F.col("n_classes")).alias("class"), "pos", "acceleration"
    )
    whole = ", ".join(f"{c} bigint" for c in [*SHAPE, "class", "range"])
    window = ["device_id", "window_us"]
    along = rows.groupBy(*window, "class").applyInArrow(_along, f"{KEY}, {whole}, readings binary, chirp binary")
    across = along.groupBy(*window, "range").applyInArrow(_across, f"{KEY}, {whole}, readings binary")
    largest = across.groupBy(*window, "class").applyInArrow(_largest, f"{KEY}, magnitude double, bin bigint")
    best = F.min(F.struct((-F.col("magnitude")).alias("m"), "bin"))["bin"].cast("int")
    return largest.groupBy(*window).agg(best.alias("dominant_bin"))


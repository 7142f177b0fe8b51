"""Count windows reduced from sorted runs, Arrow batch by Arrow batch.

Spark shuffles and sorts the rows; a task then reads each device's (and block's) run once, in order. Complete windows of a
piece of the run are reshaped into a matrix and reduced with a few vectorised calls; the rows that later windows still need are
carried to the next batch. So no window is collected into an array by an aggregate and sorted again, and overlapping windows
repeat no row outside a task. A task holds a few windows' rows, or ``PIECE_ROWS``, and matrices of at most ``CELLS`` numbers (or one window).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorline.functions.spectrum import dominant_bins
from tremorline.operators.blocks import sorted_runs

#: Rows gathered before they are reduced, and numbers in a matrix of windows.
PIECE_ROWS = 1 << 16
CELLS = 1 << 21


def _reduced(matrix: np.ndarray, missing: np.ndarray) -> tuple[np.ndarray, ...]:
    """Readings, mean, RMS, population standard deviation and dominant bin per row; ``missing`` marks absent readings."""
    held = (~missing).sum(axis=1)
    plain = np.where(missing, 0.0, matrix)
    with np.errstate(all="ignore"):
        mean = plain.sum(axis=1) / held
        rms = np.sqrt((plain * plain).sum(axis=1) / held)
        # Around a reading of the window, so that a constant window has no spread at all.
        origin = matrix[np.arange(len(matrix)), missing.argmin(axis=1)]
        off = np.where(missing, 0.0, matrix - origin[:, None])
        centre = off.sum(axis=1) / held
        off = np.where(missing, 0.0, off - centre[:, None])
        std = np.sqrt((off * off).sum(axis=1) / held)
        return held, mean, rms, std, dominant_bins(matrix)


def _windows(piece: pa.Table, first: np.ndarray, length: np.ndarray, number: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per window of ``length`` rows from row ``first`` on."""
    reading = piece.column("acceleration").combine_chunks()
    values = reading.to_numpy(zero_copy_only=False)
    absent = reading.is_null().to_numpy(zero_copy_only=False)
    times = piece.column("ts").combine_chunks()
    untimed = np.concatenate(([0], np.cumsum(times.is_null().to_numpy(zero_copy_only=False))))
    for size in np.unique(length):
        same = np.flatnonzero(length == size)
        step = max(1, CELLS // int(size))
        for at in range(0, len(same), step):
            some = same[at : at + step]
            start = first[some]
            rows = start[:, None] + np.arange(size)
            held, mean, rms, std, bins = _reduced(values[rows], absent[rows])
            none = held == 0
            last = start + size - 1
            # Rows without a time come first, so a window's least time is that of the row after them.
            without = untimed[last + 1] - untimed[start]
            earliest = pa.array(start + without, mask=without == size)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("device_id").take(pa.array(start)).combine_chunks(),
                    pa.array(number[some]),
                    pa.array(np.full(len(some), size, np.int64)),
                    pa.array(rms, mask=none),
                    pa.array(mean, mask=none),
                    pa.array(std, mask=none),
                    times.take(earliest),
                    times.take(pa.array(last)),
                    piece.column("ground_truth").take(pa.array(last)).combine_chunks(),
                    pa.array(bins),
                ],
                names=["device_id", "window_id", "n", "rms", "mean", "std", "window_start", "window_end", "ground_truth", "dominant_bin"],
            )


def _reducer(size: int, hop: int, length: int, blocks: bool) -> Callable:
    """Windows of runs of rows (device_id, ts, acceleration, ground_truth, and block, _start where keys were cut)."""

    def codes(piece: pa.Table, name: str) -> np.ndarray:
        column = piece.column(name).combine_chunks().dictionary_encode(null_encoding="encode")
        return column.indices.to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        n_waiting = 0
        # Of the run that is still open: the position of its first waiting row, and its next window.
        carried: tuple[int, int] | None = None

        def reduce(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, n_waiting, carried
            piece = pa.Table.from_batches(waiting).combine_chunks()
            new_run = np.diff(codes(piece, "device_id")) != 0
            if blocks:
                new_run |= np.diff(piece.column("block").to_numpy()) != 0
            begin = np.concatenate(([0], np.flatnonzero(new_run) + 1))
            rows = np.diff(np.append(begin, len(piece)))
            if blocks:
                bounds = piece.column("block").to_numpy()[begin] * length
                base = piece.column("_start").to_numpy()[begin].astype(np.int64)
                upper = bounds + length
            else:
                bounds = np.zeros(len(begin), np.int64)
                base = np.zeros(len(begin), np.int64)
                upper = np.full(len(begin), np.iinfo(np.int64).max)
            following = bounds // hop
            if carried is not None:
                base[0], following[0] = carried
            reached = np.minimum(base + rows, upper) // hop
            due = np.maximum(reached - following, 0)
            owner = np.repeat(np.arange(len(begin)), due)
            number = following[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(due) - due, due)
            end = (number + 1) * hop
            start = np.maximum(end - size, 0)
            yield from _windows(piece, begin[owner] + start - base[owner], end - start, number)
            following = int(following[-1] + due[-1])
            needed = max(0, (following + 1) * hop - size)
            skipped = int(min(max(needed - base[-1], 0), rows[-1]))
            # A copy of what stays: a slice would keep all of the piece in memory.
            left = piece.take(pa.array(np.arange(begin[-1] + skipped, len(piece))))
            if final or base[-1] + rows[-1] >= upper[-1]:
                left = piece.slice(0, 0)
            if len(left) or not final:
                # One row at least stays while the run is open, to tell whether it goes on.
                kept = left if len(left) else piece.take(pa.array([len(piece) - 1]))
                carried = (int(base[-1] + rows[-1] - len(kept)), following)
                waiting, n_waiting = kept.to_batches(), len(kept)

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                n_waiting += batch.num_rows
                if n_waiting >= max(PIECE_ROWS, 2 * (size + hop)):
                    yield from reduce(final=False)
        if waiting:
            yield from reduce(final=True)

    return run


def reduce_runs(samples: DataFrame, size: int, hop: int | None = None, block_rows: int | None = None) -> DataFrame:
    """Time-domain features and dominant bin of every due count window; see ``assign_count_windows`` for which these are.

    Missing readings count as samples, enter no mean and leave the spectrum undefined (bin 1). Truth is that of the last row.
    """
    hop = size if hop is None else hop
    runs, keys, length = sorted_runs(samples, hop=hop, reach=max(0, size - hop), block_rows=block_rows)
    blocks = "block" in keys
    rows = runs.select("device_id", *(["block", "_start"] if blocks else []), "ts", F.col("acceleration").cast("double"), "ground_truth")
    kinds = samples.schema
    schema = T.StructType(
        [
            T.StructField("device_id", kinds["device_id"].dataType),
            T.StructField("window_id", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("rms", T.DoubleType()),
            T.StructField("mean", T.DoubleType()),
            T.StructField("std", T.DoubleType()),
            T.StructField("window_start", kinds["ts"].dataType),
            T.StructField("window_end", kinds["ts"].dataType),
            T.StructField("ground_truth", kinds["ground_truth"].dataType),
            T.StructField("dominant_bin", T.IntegerType()),
        ]
    )
    return rows.mapInArrow(_reducer(size, hop, length, blocks), schema)

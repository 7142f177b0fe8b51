"""Count windows on a stream: per-device state, since Spark has no row-count window for streams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tremorline.functions.spectrum import dominant_bins
from tremorline.operators.detect import RMS_THRESHOLD, STD_THRESHOLD, flag_anomalies
from tremorline.operators.features import with_frequencies

WINDOW_COLUMNS = (
    "device_id string, window_id bigint, n bigint, rms double, mean double, std double, "
    "dominant_bin int, start_us bigint, end_us bigint, ground_truth boolean"
)
STATE_COLUMNS = (
    "seen bigint, ts_us array<bigint>, seq array<bigint>, acceleration array<double>, "
    "ground_truth array<boolean>"
)
FIELDS = ["ts_us", "seq", "acceleration", "ground_truth"]
DTYPES = ["int64", "int64", "float64", "bool"]
#: Readings of windows that are reduced at once.
CELLS = 4_000_000
#: Before any time.
NEVER = -(1 << 62)
LATE_COLUMNS = "late_ts_us bigint, late_seq bigint, late_acceleration double, late_ground_truth boolean"
ORDERED = [part.split()[0] for part in f"{WINDOW_COLUMNS}, {LATE_COLUMNS}".split(", ")]


def _advance(
    device: str | None, seen: int, kept: list[np.ndarray], new: list[np.ndarray], size: int, hop: int
) -> tuple[Iterator[pd.DataFrame], int, list[np.ndarray]]:
    """The windows that ``new`` samples of one device complete, in slices, the number of samples seen and the ones to keep."""
    ts_us, seq, x, truth = (np.concatenate(pair) for pair in zip(kept, new, strict=True))
    total = seen + len(new[0])
    base = total - len(x)
    rest = max(0, max(0, (total // hop + 1) * hop - size) - base)

    def windows() -> Iterator[pd.DataFrame]:
        every = np.arange(seen // hop + 1, total // hop + 1)
        for at in range(0, len(every), max(1, CELLS // size)):
            due = every[at : at + max(1, CELLS // size)]
            last = due * hop - base
            first = np.maximum(due * hop - size, 0) - base
            n = last - first
            rms, mean, std, bins = (np.empty(len(due)) for _ in range(4))
            # The first windows may be shorter than the rest; windows of one length are reduced together.
            for length in np.unique(n):
                same = np.flatnonzero(n == length)
                matrix = x[first[same][:, None] + np.arange(length)]
                rms[same] = np.sqrt(np.mean(np.square(matrix), axis=1))
                mean[same] = np.mean(matrix, axis=1)
                std[same] = np.std(matrix, axis=1)
                bins[same] = dominant_bins(matrix)
            yield pd.DataFrame(
                {
                    "device_id": device,
                    "window_id": due - 1,
                    "n": n,
                    "rms": rms,
                    "mean": mean,
                    "std": std,
                    "dominant_bin": bins.astype("int32"),
                    "start_us": ts_us[first],
                    "end_us": ts_us[last - 1],
                    "ground_truth": truth[last - 1],
                }
            )

    return windows(), total, [column[rest:] for column in (ts_us, seq, x, truth)]


def _sorted_batch(batches: Iterable[pd.DataFrame], more: list | None = None) -> list[np.ndarray]:
    """The samples of a micro-batch, and those held back before, in order."""
    parts = list(batches)
    new = [
        np.concatenate([*([np.asarray(more[k], dtype=DTYPES[k])] if more else []), *[part[name].to_numpy().astype(DTYPES[k]) for part in parts]])
        if parts or more else np.empty(0, DTYPES[k])
        for k, name in enumerate(FIELDS)
    ]
    order = np.lexsort((new[1], new[0]))
    return [column[order] for column in new]


def _arrays(columns: Iterable) -> list[np.ndarray]:
    return [np.asarray(column, dtype=dtype) for column, dtype in zip(columns, DTYPES, strict=True)]


def cut_windows(
    key: tuple, batches: Iterable[pd.DataFrame], state: GroupState, size: int, hop: int
) -> Iterator[pd.DataFrame]:
    """Emit the windows that the new samples of one device complete and keep what later ones need.

    State is the number of samples seen and fewer than ``size + hop`` samples.
    """
    seen, *kept = state.get if state.exists else (0, *([] for _ in FIELDS))
    windows, total, rest = _advance(key[0], seen, _arrays(kept), _sorted_batch(batches), size, hop)
    yield from windows
    state.update((total, *(column.tolist() for column in rest)))


def cut_windows_in_order(
    key: tuple, batches: Iterable[pd.DataFrame], state: GroupState, size: int, hop: int, lateness_us: int
) -> Iterator[pd.DataFrame]:
    """As above, but samples wait until they are ``lateness_us`` older than the newest of their device.

    Then they are released in order of time. A sample that comes when others of its time or later ones have been released is late, and is
    given back as it is. State is, besides, the time up to which samples were released and the samples waiting.
    """
    seen, horizon, *held = state.get if state.exists else (0, NEVER, *([] for _ in range(2 * len(FIELDS))))
    kept, waiting = held[: len(FIELDS)], held[len(FIELDS) :]
    came = _sorted_batch(batches)
    late = came[0] <= horizon
    if late.any():
        yield pd.DataFrame({"device_id": key[0], **{f"late_{n}": c[late] for n, c in zip(FIELDS, came, strict=True)}}).reindex(columns=ORDERED)
    here = _sorted_batch([pd.DataFrame({n: c[~late] for n, c in zip(FIELDS, came, strict=True)})], waiting)
    if len(here[0]):
        horizon = max(horizon, int(here[0][-1]) - lateness_us)
    ready = here[0] <= horizon
    windows, total, rest = _advance(key[0], seen, _arrays(kept), [c[ready] for c in here], size, hop)
    for frame in windows:
        yield frame.reindex(columns=ORDERED)
    state.update((total, horizon, *(c.tolist() for c in rest), *(c[~ready].tolist() for c in here)))


def stream_count_windows(samples: DataFrame, size: int, hop: int | None = None) -> DataFrame:
    """Every complete count window of a sample stream with all its features.

    Equal to the batch result when each device's samples arrive in order across micro-batches; inside a
    micro-batch they are sorted. There is no late-data rule: a sample that comes late counts when it comes.
    A trailing partial window stays in the state. What one task holds is the device's share of a
    micro-batch, so bound those with the source's ``maxFilesPerTrigger``.
    """
    timed = samples.select("device_id", F.unix_micros("ts").alias("ts_us"), *FIELDS[1:])
    windows = timed.groupBy("device_id").applyInPandasWithState(
        partial(cut_windows, size=size, hop=size if hop is None else hop),
        outputStructType=WINDOW_COLUMNS,
        stateStructType=STATE_COLUMNS,
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout,
    )
    return with_frequencies(
        windows.withColumn("window_start", F.timestamp_micros("start_us"))
        .withColumn("window_end", F.timestamp_micros("end_us"))
        .drop("start_us", "end_us")
    )


def stream_count_windows_in_order(samples: DataFrame, size: int, lateness: str, hop: int | None = None) -> DataFrame:
    """Every complete count window of a stream whose samples may come out of order, and the samples that come too late.

    A device's samples wait, in the state, until its newest is ``lateness`` later, and are counted in order of time then; so the
    windows do not depend on the order of arrival within ``lateness``. A row is a window, or a late sample: then all columns of the
    window are missing but the device, and ``late_ts``, ``late_seq``, ``late_acceleration`` and ``late_ground_truth`` are set.
    ``sinks.write_ordered_windows`` keeps the two apart. What is younger than ``lateness`` stays in the state.
    """
    lateness_us = int(pd.Timedelta(lateness) / pd.Timedelta("1us"))
    state = STATE_COLUMNS.replace("seen bigint", "seen bigint, horizon bigint")
    state += ", " + ", ".join(f"waiting_{part}" for part in STATE_COLUMNS.split(", ")[1:])
    timed = samples.where(F.col("ts").isNotNull()).select("device_id", F.unix_micros("ts").alias("ts_us"), *FIELDS[1:])
    rows = timed.groupBy("device_id").applyInPandasWithState(
        partial(cut_windows_in_order, size=size, hop=size if hop is None else hop, lateness_us=lateness_us),
        outputStructType=f"{WINDOW_COLUMNS}, {LATE_COLUMNS}",
        stateStructType=state,
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout,
    )
    return with_frequencies(
        rows.withColumn("window_start", F.timestamp_micros("start_us"))
        .withColumn("window_end", F.timestamp_micros("end_us"))
        .withColumn("late_ts", F.timestamp_micros("late_ts_us"))
        .drop("start_us", "end_us", "late_ts_us")
    )


def stream_detect(
    samples: DataFrame,
    size: int,
    hop: int | None = None,
    rms_threshold: float = RMS_THRESHOLD,
    std_threshold: float = STD_THRESHOLD,
) -> DataFrame:
    """The detection pipeline on a stream."""
    return flag_anomalies(stream_count_windows(samples, size, hop), rms_threshold, std_threshold)

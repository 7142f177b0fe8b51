"""The newest rows of a key by a summary of bounded size that tasks build and merge.

A task holds the newest order keys of each device in a buffer. What it gives back is a ladder: the buffer's 1st, 2nd, ...
newest keys at ranks that grow by a quarter, each with the number of rows it stands for. Ladders of disjoint rows merge
by putting their rungs in one order: where the running sum of rows reaches ``n``, at least ``n`` rows are as new or newer, and
of the rows that are, a quarter at most (and one rung) is not counted. So rows older than that rung may go before any shuffle,
whatever ``n`` is and however the rows of a device are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremorline.operators.blocks import broadcast_if_small
from tremorline.session import cut_lineage

#: Order keys that a task holds before it gives back the ladders of what it has and begins anew.
HELD = 4_000_000
GROWTH = 1.25
OLDEST = -(1 << 63)

LADDER = "device string, major bigint, minor bigint, rows bigint"


def ranks(n: int) -> np.ndarray:
    """Ranks from 1 to ``n``, each at most ``GROWTH`` times the one before, or one more."""
    found = [1]
    while found[-1] < n:
        found.append(min(n, max(found[-1] + 1, int(found[-1] * GROWTH))))
    return np.array(found)


def newest_keys(major: np.ndarray, minor: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` newest keys, newest first."""
    return np.lexsort((minor, major))[::-1][:n]


class Buffers:
    """The newest ``n`` order keys of each device, of the rows seen so far."""

    def __init__(self, n: int):
        self.n, self.rungs = n, ranks(n)
        self.clear()

    def clear(self) -> None:
        self.keys: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.sizes: dict[str | None, int] = {}
        self.held = 0

    def add(self, device: str | None, major: np.ndarray, minor: np.ndarray) -> None:
        self.keys.setdefault(device, []).append((major, minor))
        size = self.sizes.get(device, 0) + len(major)
        self.sizes[device], self.held = size, self.held + len(major)
        if size > 2 * self.n:
            self.prune(device)

    def prune(self, device: str | None) -> tuple[np.ndarray, np.ndarray]:
        major, minor = (np.concatenate(part) for part in zip(*self.keys[device], strict=True))
        best = newest_keys(major, minor, self.n)
        kept = major[best], minor[best]
        self.held += len(best) - self.sizes[device]
        self.keys[device], self.sizes[device] = [kept], len(best)
        return kept

    def ladders(self) -> Iterator[pa.RecordBatch]:
        for device in list(self.keys):
            major, minor = self.prune(device)
            last = len(major)
            at = np.append(self.rungs[self.rungs < last], last)
            columns = [pa.array([device] * len(at), pa.string()), pa.array(major[at - 1]), pa.array(minor[at - 1]), pa.array(np.diff(at, prepend=0))]
            yield pa.RecordBatch.from_arrays(columns, names=["device", "major", "minor", "rows"])


def _build(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffers = Buffers(n)
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column("device").dictionary_encode("encode")
            index = codes.indices.to_numpy(zero_copy_only=False)
            major, minor = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("major", "minor"))
            order = np.argsort(index, kind="stable")
            edges = np.flatnonzero(np.diff(index[order], prepend=-1))
            for part in np.split(order, edges[1:]):
                buffers.add(codes.dictionary[int(index[part[0]])].as_py(), major[part], minor[part])
            if buffers.held > HELD:
                yield from buffers.ladders()
                buffers.clear()
        yield from buffers.ladders()

    return run


def order_keys(rows: DataFrame, order: tuple[str, str] = ("ts", "seq")) -> list[Column]:
    """Time and number as integers; missing ones are the oldest."""
    times, numbers = order
    return [
        F.coalesce(F.unix_micros(times), F.lit(OLDEST)).alias("major"),
        F.coalesce(F.col(numbers).cast("bigint"), F.lit(OLDEST)).alias("minor"),
    ]


def ladders(rows: DataFrame, n: int, key: str = "device_id") -> DataFrame:
    """The ladders of all tasks; reads the key and the order columns only."""
    return rows.select(F.col(key).cast("string").alias("device"), *order_keys(rows)).mapInArrow(_build(n), LADDER)


def cutoffs(found: DataFrame, n: int) -> DataFrame:
    """(device, major, minor): the rung from which on a device has ``n`` rows; devices with fewer have none."""
    merged = found.groupBy("device", "major", "minor").agg(F.sum("rows").alias("rows"))
    newest_first = W.partitionBy("device").orderBy(F.desc("major"), F.desc("minor"))
    counted = merged.withColumn("seen", F.sum("rows").over(newest_first.rowsBetween(W.unboundedPreceding, W.currentRow)))
    reached = counted.where(F.col("seen") >= n)
    return reached.groupBy("device").agg(F.max(F.struct("major", "minor")).alias("cut")).select("device", "cut.*")


def not_older(rows: DataFrame, n: int, key: str = "device_id") -> DataFrame:
    """The rows that may be among the newest ``n`` of their key: these, about a quarter more, and rows equal to the last one.

    One pass over key and order columns, and a filter; nothing of the rows themselves is shuffled.
    """
    cut = cut_lineage(cutoffs(ladders(rows, n, key), n))
    cut = cut.select(F.col("device").alias("_device"), F.col("major").alias("_major"), F.col("minor").alias("_minor"))
    major, minor = order_keys(rows)
    newer = F.col("_major").isNull() | (major > F.col("_major")) | ((major == F.col("_major")) & (minor >= F.col("_minor")))
    joined = rows.join(broadcast_if_small(cut, cut.count()), F.col(key).cast("string").eqNullSafe(F.col("_device")), "left")
    return joined.where(newer).select(*[F.col(f"`{c}`") for c in rows.columns])

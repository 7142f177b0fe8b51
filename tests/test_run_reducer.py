"""Windows reduced from sorted runs against the same windows by aggregates."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from catalog import queries as q
from tests.helpers import at, rows_of, samples
from tremorline.functions.spectrum import dominant_bin
from tremorline.model import SAMPLE_SCHEMA
from tremorline.operators import run_reducer
from tremorline.operators.features import count_window_aggregates
from tremorline.operators.run_reducer import _reducer, reduce_runs

EXACT = ("device_id", "window_id", "n", "window_start", "window_end", "ground_truth", "dominant_bin")
ROUNDED = ("round(rms, 9)", "round(mean, 9)", "round(std, 9)")


def by_aggregates(frame, size, hop=None):
    return count_window_aggregates(frame, size, hop, True).withColumn("dominant_bin", dominant_bin("readings"))


@pytest.mark.parametrize("size, hop", [(16, None), (32, 8), (10, 3), (3, 7), (1, 1)])
def test_windows_equal_those_of_aggregates(spark, sf_dir, size, hop):
    frame = q.crowded_samples(spark, sf_dir)
    wanted = rows_of(by_aggregates(frame, size, hop), *EXACT, *ROUNDED)
    assert wanted
    assert rows_of(reduce_runs(frame, size, hop), *EXACT, *ROUNDED) == wanted
    assert rows_of(reduce_runs(frame, size, hop, 40), *EXACT, *ROUNDED) == wanted


def plain(runs, size, hop):
    found = []
    for device, values in runs:
        for k in range(1, len(values) // hop + 1):
            rows = values[max(0, k * hop - size) : k * hop]
            found.append((device, k - 1, len(rows), sum(rows) / len(rows)))
    return found


@pytest.mark.parametrize("size, hop", [(4, 4), (6, 2), (5, 3), (2, 5), (7, 7)])
@pytest.mark.parametrize("cut", [1, 3, 8, 100])
def test_batches_may_end_anywhere(monkeypatch, size, hop, cut):
    """Runs that end with a batch, one-row batches, devices without a window, a missing device."""
    monkeypatch.setattr(run_reducer, "PIECE_ROWS", 5)
    runs = [("a", 24), ("b", 1), ("c", 3), (None, 17), ("d", 8), ("e", 40)]
    counter = itertools.count()
    runs = [(d, [float(next(counter)) for _ in range(n)]) for d, n in runs]
    flat = [(d, v) for d, values in runs for v in values]
    whole = pa.RecordBatch.from_arrays(
        [
            pa.array([d for d, _ in flat], pa.string()),
            pa.array(range(len(flat)), pa.int64()).cast(pa.timestamp("us", "UTC")),
            pa.array([v for _, v in flat]),
            pa.array([False] * len(flat)),
        ],
        names=["device_id", "ts", "acceleration", "ground_truth"],
    )
    batches = [whole.slice(i, cut) for i in range(0, len(flat), cut)]
    got = [r for b in _reducer(size, hop, 1 << 20, False)(iter([*batches, whole.slice(0, 0)])) for r in b.to_pylist()]
    found = [(r["device_id"], r["window_id"], r["n"], r["mean"]) for r in got]
    assert sorted(found, key=repr) == sorted(plain(runs, size, hop), key=repr)


def test_odd_readings_and_times(spark):
    values = [None, 1.0, 2.0, 3.0] + [None] * 4 + [5.0] * 4 + [float("nan")] * 4 + [float("inf"), 1.0, 1.0, 1.0]
    rows = [("d", None if i < 6 else at(i), i, v, None if i == 7 else i % 2 == 0) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, SAMPLE_SCHEMA)
    wanted = rows_of(by_aggregates(frame, 4), *EXACT, *ROUNDED)
    # As text: a NaN does not equal itself.
    assert len(wanted) == 5 and repr(rows_of(reduce_runs(frame, 4), *EXACT, *ROUNDED)) == repr(wanted)
    assert reduce_runs(frame, 4).where("window_id = 2").first()["std"] == 0.0
    assert reduce_runs(frame.limit(0), 4).count() == 0


def test_one_exchange_one_sort_no_arrays(spark, sf_dir):
    plan = reduce_runs(q.samples(spark, sf_dir), 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    assert "Aggregate" not in plan and "Window" not in plan


def test_a_window_longer_than_a_piece(spark, monkeypatch):
    values = list(np.sin(np.arange(5000) * 0.3))
    frame = samples(spark, values)
    wanted = rows_of(by_aggregates(frame, 2400, 1200), *EXACT, *ROUNDED)
    monkeypatch.setattr(run_reducer, "CELLS", 100)
    assert rows_of(reduce_runs(frame, 2400, 1200), *EXACT, *ROUNDED) == wanted

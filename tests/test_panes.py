"""Hopping windows from panes against windows cut out of a list."""

import math

import pytest

from catalog import queries as q
from pyspark.sql import functions as F
from tests.helpers import at, rows_of, samples
from tremorline.model import SAMPLE_SCHEMA
from tremorline.operators.features import count_window_aggregates
from tremorline.operators.panes import hopping_window_features

COLUMNS = ("device_id", "window_id", "n", "mean", "rms", "std", "window_start", "window_end", "ground_truth")


def plain(values, size, hop):
    """{window_id: (n, mean, rms, std)} where a reading may be missing."""
    found = {}
    for k in range(1, len(values) // hop + 1):
        rows = values[max(0, k * hop - size) : k * hop]
        x = [v for v in rows if v is not None]
        mean = math.fsum(x) / len(x) if x else None
        found[k - 1] = (
            len(rows),
            mean,
            math.sqrt(math.fsum(v * v for v in x) / len(x)) if x else None,
            math.sqrt(math.fsum((v - mean) ** 2 for v in x) / len(x)) if x else None,
        )
    return found


def check(got, want):
    assert sorted(got) == sorted(want)
    for k, row in want.items():
        for one, other in zip(got[k], row, strict=True):
            assert one == other or one == pytest.approx(other, rel=1e-9, abs=1e-9), (k, got[k], row)


@pytest.mark.parametrize(
    "size, hop, total, block_rows",
    [(6, 2, 21, None), (6, 4, 50, 8), (10, 3, 64, 9), (10, 1, 40, 7), (30, 7, 40, 8), (12, 8, 7, None), (5, 5, 23, 10), (1, 1, 4, None)],
)
def test_windows_equal_those_cut_from_a_list(spark, size, hop, total, block_rows):
    values = [None if i % 11 == 3 else float((i * 37) % 19) + 1e6 for i in range(total)]
    frame = hopping_window_features(samples(spark, values), size, hop, block_rows)
    got = {r.window_id: (r.n, r["mean"], r.rms, r["std"]) for r in frame.collect()}
    check(got, plain(values, size, hop))


def test_times_and_truth_are_those_of_first_and_last(spark):
    frame = samples(spark, range(20), rate=1.0, truth=[i % 3 == 0 for i in range(20)])
    rows = hopping_window_features(frame, 6, 4).orderBy("window_id").collect()
    ends = [4 * (r.window_id + 1) - 1 for r in rows]
    assert [r.ground_truth for r in rows] == [e % 3 == 0 for e in ends]
    seconds = frame.select(F.min("ts")).first()[0]
    assert [(r.window_end - seconds).total_seconds() for r in rows] == ends
    assert [(r.window_start - seconds).total_seconds() for r in rows] == [max(0, e - 5) for e in ends]


def test_windows_without_readings_and_with_odd_ones(spark):
    values = [None] * 8 + [1.0] * 4 + [float("nan")] + [2.0] * 11 + [float("inf")] + [3.0] * 11
    frame = samples(spark, values)
    got = {r.window_id: r for r in hopping_window_features(frame, 8, 4).collect()}
    assert got[1].n == 8 and got[1]["mean"] is None and got[1].rms is None and got[1]["std"] is None
    assert got[2]["mean"] == 1.0 and got[2]["std"] == 0.0
    assert all(math.isnan(got[k]["mean"]) and math.isnan(got[k]["std"]) for k in (3, 4))
    assert got[5]["mean"] == 2.0 and got[5]["std"] == 0.0  # no trace of the NaN before
    assert got[6]["mean"] == got[7]["mean"] == math.inf and math.isnan(got[7]["std"])
    assert got[8]["mean"] == 3.0 and got[8]["std"] == 0.0


def test_a_large_offset_leaves_the_spread_alone(spark):
    values = [1e9 + (i % 2) * 1e-3 for i in range(400)]
    for row in hopping_window_features(samples(spark, values), 100, 10).where("window_id > 8").collect():
        assert row["std"] == pytest.approx(5e-4, rel=1e-3)


def test_panes_do_not_depend_on_blocks_or_the_number_of_devices(spark, sf_dir):
    frame = q.crowded_samples(spark, sf_dir)
    rounded = [c if c not in ("mean", "rms", "std") else F.round(c, 8) for c in COLUMNS]
    whole = rows_of(hopping_window_features(frame, 32, 8), *rounded)
    assert whole and rows_of(hopping_window_features(frame, 32, 8, 40), *rounded) == whole
    repeated = count_window_aggregates(frame, 32, 8, with_array=True)
    assert rows_of(repeated, *rounded) == whole


def test_missing_device_and_empty_table(spark):
    rows = [(None, at(i), i, float(i), False) for i in range(9)]
    frame = spark.createDataFrame(rows, SAMPLE_SCHEMA)
    got = {r.window_id: (r.device_id, r["mean"]) for r in hopping_window_features(frame, 4, 2).collect()}
    assert got == {0: (None, 0.5), 1: (None, 1.5), 2: (None, 3.5), 3: (None, 5.5)}
    assert hopping_window_features(frame.limit(0), 4, 2).count() == 0


def test_rows_are_neither_repeated_nor_shuffled_twice(spark, sf_dir):
    plan = hopping_window_features(q.samples(spark, sf_dir), 1000, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    assert plan.count("Exchange hashpartitioning") == 1

import random

import pytest

from tests.helpers import at, rows_of, samples
from tremorline.model import FAULT_SCHEMA, SAMPLE_SCHEMA
from tremorline.operators import labels
from tremorline.operators.labels import label_faults, merge_intervals

BOTH_WAYS = pytest.mark.parametrize("options", [{}, {"max_pieces": 0}, {"max_pieces": 0, "block_rows": 8}])


def faults(spark, *intervals):
    rows = [(d, None if a is None else at(a), None if b is None else at(b)) for d, a, b in intervals]
    return spark.createDataFrame(rows, FAULT_SCHEMA)


def true_at(frame):
    return [r.seq for r in frame.where("ground_truth").orderBy("seq").collect()]


@BOTH_WAYS
def test_fault_is_closed_at_both_ends(spark, options):
    frame = label_faults(samples(spark, range(12)), faults(spark, ("d1", 0.005, 0.008)), **options)
    assert frame.count() == 12
    assert true_at(frame) == [5, 6, 7, 8]


@BOTH_WAYS
def test_no_schedule_means_no_fault(spark, options):
    assert true_at(label_faults(samples(spark, range(12)), faults(spark), **options)) == []
    other = faults(spark, ("d2", 0.0, 1.0), ("d1", None, 1.0), ("d1", 0.0, None), ("d1", 0.009, 0.001))
    assert true_at(label_faults(samples(spark, range(12)), other, **options)) == []


@BOTH_WAYS
def test_fault_from_the_very_first_sample(spark, options):
    assert true_at(label_faults(samples(spark, range(12)), faults(spark, ("d1", 0.0, 0.002)), **options)) == [0, 1, 2]


@BOTH_WAYS
def test_overlapping_faults_do_not_repeat_samples(spark, options):
    rng = random.Random(5)
    devices = ["a", "b", "c"]
    times = [(rng.choice(devices), rng.uniform(0, 20_000)) for _ in range(300)]
    spans = [(rng.choice(devices[:2]), s, s + rng.choice([0, 5, 900, 8_000])) for s in
             [rng.uniform(0, 20_000) for _ in range(40)]]
    spans += spans[:5]
    frame = spark.createDataFrame([(d, at(t), i, 0.0, False) for i, (d, t) in enumerate(times)], SAMPLE_SCHEMA)
    got = {r.seq: r.ground_truth for r in label_faults(frame, faults(spark, *spans), **options).collect()}
    assert len(got) == 300
    assert got == {
        i: any(d == e and a <= t <= b for e, a, b in spans) for i, (d, t) in enumerate(times)
    }


def test_merge_joins_what_overlaps(spark):
    merged = merge_intervals(faults(spark, ("d", 0, 5), ("d", 5, 7), ("d", 1, 2), ("d", 8, 9), ("e", 0, 1)))
    assert rows_of(merged, "device_id", "start_ts", "end_ts") == rows_of(
        faults(spark, ("d", 0, 7), ("d", 8, 9), ("e", 0, 1)), "device_id", "start_ts", "end_ts"
    )


def test_small_schedule_is_broadcast_and_the_samples_stay_put(spark):
    frame = label_faults(samples(spark, range(12)), faults(spark, ("d1", 0.005, 0.008)))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_many_faults_within_an_hour_are_swept(spark):
    spans = [("d1", 0.1 * i, 0.1 * i + 0.05) for i in range(100)]
    frame = samples(spark, range(200), times=[0.05 * i + 0.02 for i in range(200)])
    labelled = label_faults(frame, faults(spark, *spans))
    assert "Window" in labelled._jdf.queryExecution().executedPlan().toString()
    assert true_at(labelled) == [i for i in range(200) if i % 2 == 0]


def test_a_schedule_too_large_to_broadcast_is_not(spark, monkeypatch):
    """However many pieces are allowed; the labels are the same."""
    frame, schedule = samples(spark, range(12)), faults(spark, ("d1", 0.005, 0.008))
    monkeypatch.setattr(labels, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(labels, "_label_by_hour", lambda *_: pytest.fail("broadcast"))
    assert true_at(label_faults(frame, schedule, max_pieces=10**9)) == [5, 6, 7, 8]

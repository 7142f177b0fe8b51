import datetime as dt
import random

import numpy as np
import pytest

from tests.helpers import at, rows_of
from tremorline.model import SAMPLE_SCHEMA
from tremorline.operators import newest
from tremorline.operators.blocks import number_rows
from tremorline.operators.windows import latest_n

COLUMNS = ["device_id", "ts", "seq", "acceleration"]


def uneven(spark, tasks=8):
    """One device with most rows, one without a name, ties in time and number, missing times and numbers."""
    rnd, rows = random.Random(1), []
    for i in range(4000):
        time = None if rnd.random() < 0.05 else at(float(rnd.randint(0, 400)))
        rows.append(("big" if i % 4 else None, time, None if i % 13 == 0 else i // 20, float(i), False))
    rows += [(f"small{d}", at(float(i)), i, float(i), False) for d in range(4) for i in range(30)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, SAMPLE_SCHEMA).repartition(tasks)


def by_position(frame, n):
    numbered, _, _ = number_rows(frame, descending=True, first=n)
    return rows_of(numbered, *COLUMNS)


@pytest.mark.parametrize("n", [1, 17, 1000, 2500, 10_000])
@pytest.mark.parametrize("held", [1, 300, 4_000_000])
def test_no_row_of_the_newest_is_left_out(spark, monkeypatch, n, held):
    monkeypatch.setattr(newest, "HELD", held)
    frame = uneven(spark)
    rest = newest.not_older(frame, n)
    assert rest.columns == frame.columns
    assert by_position(rest, n) == by_position(frame, n)


def test_one_answer_below_and_above_the_limit(spark):
    frame = uneven(spark)
    want = by_position(frame, 1005)
    for block_rows in (None, 256):
        assert rows_of(latest_n(frame, 1005, block_rows=block_rows), *COLUMNS) == want
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2000")
    try:
        assert rows_of(latest_n(frame, 1005), *COLUMNS) == want
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_what_is_left_is_in_proportion_to_n(spark):
    """However the rows are spread over tasks, about n of 200 000 rows pass, and a ladder has few rungs."""
    frame = spark.range(200_000, numPartitions=16).selectExpr(
        "'d' AS device_id", "timestamp_micros(id * 1000) AS ts", "id AS seq", "0.0D AS acceleration", "false AS ground_truth"
    )
    for spread in (frame, frame.repartition(16)):
        assert 5000 <= newest.not_older(spread, 5000).count() <= 1.3 * 5000 + 1
    assert newest.ladders(frame, 5000).count() <= 16 * len(newest.ranks(5000)) and len(newest.ranks(10**9)) < 120


def test_ladders_read_only_the_order_columns(spark, tmp_path):
    uneven(spark).write.parquet(f"{tmp_path}/rows")
    plan = newest.ladders(spark.read.parquet(f"{tmp_path}/rows"), 50)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<device_id:string,ts:timestamp,seq:bigint>" in plan and "Exchange" not in plan


def test_ranks_grow_by_a_quarter():
    for n in (1, 2, 3, 10, 12_345):
        found = newest.ranks(n)
        assert found[0] == 1 and found[-1] == n
        assert all(b <= max(a + 1, 1.25 * a) for a, b in zip(found, found[1:], strict=False))


def test_buffer_holds_the_newest():
    rnd = np.random.default_rng(3)
    keys, buffers = rnd.integers(0, 500, 10_000), newest.Buffers(40)
    for part in np.split(keys, 50):
        buffers.add("d", part, np.zeros(len(part), np.int64))
        assert buffers.held <= 2 * 40
    assert sorted(buffers.prune("d")[0]) == sorted(keys)[-40:]


def test_empty_table_and_devices_with_few_rows(spark):
    assert newest.not_older(spark.createDataFrame([], SAMPLE_SCHEMA), 5).count() == 0
    few = spark.createDataFrame([("d", at(1.0), 1, 1.0, False), (None, None, None, 2.0, False)], SAMPLE_SCHEMA)
    assert newest.not_older(few, 5).count() == 2
    early = spark.createDataFrame([("d", dt.datetime(1, 1, 2), i, 1.0, False) for i in range(4)], SAMPLE_SCHEMA)
    assert {r.seq for r in newest.not_older(early, 1).collect()} == {3}

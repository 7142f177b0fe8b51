import datetime as dt

import pytest

from catalog import queries as q
from pyspark.sql import functions as F
from tests.helpers import at, rows_of, samples
from tremorline.model import SAMPLE_SCHEMA
from tremorline.operators.blocks import number_rows, split_crowded_keys
from tremorline.operators.features import count_window_aggregates, extract_features
from tremorline.operators.windows import buffer_depth, latest_n


def test_last_thousand_of_2500(spark):
    frame = samples(spark, range(2500), times=[float(i) for i in range(2500)])
    kept = latest_n(frame, 1000)
    assert kept.agg(F.min("acceleration"), F.max("acceleration"), F.count("*")).first()[:] == (1500.0, 2499.0, 1000)
    assert buffer_depth(frame, 1000).first()[:] == ("d1", 1000, True)


def test_last_n_beyond_the_limit_of_the_group_limit(spark):
    frame = samples(spark, range(2500), times=[float(i) for i in range(2500)])
    for block_rows in (None, 400):
        kept = latest_n(frame, 1200, block_rows=block_rows)
        assert kept.agg(F.min("acceleration"), F.max("acceleration"), F.count("*")).first()[:] == (
            1300.0, 2499.0, 1200)


def test_small_last_n_is_limited_before_the_shuffle(spark, sf_dir):
    plan = latest_n(q.samples(spark, sf_dir), 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_buffer_fills_at_capacity(spark):
    assert buffer_depth(samples(spark, range(4)), 5).first()[:] == ("d1", 4, False)
    assert buffer_depth(samples(spark, range(5)), 5).first()[:] == ("d1", 5, True)
    assert buffer_depth(samples(spark, range(9)), 5).first()[:] == ("d1", 5, True)


def test_trailing_partial_window_is_not_emitted(spark):
    frame = count_window_aggregates(samples(spark, range(23)), 10, with_array=False)
    assert rows_of(frame, "window_id", "n", "mean") == [(0, 10, 4.5), (1, 10, 14.5)]


@pytest.mark.parametrize(
    "size, hop, total, block_rows",
    [(6, 2, 21, None), (4, 4, 21, 8), (3, 5, 21, 8), (10, 3, 25, 8), (1, 1, 5, None), (30, 7, 40, 8)],
)
def test_windows_hold_the_last_size_samples_at_every_hop(spark, size, hop, total, block_rows):
    frame = count_window_aggregates(samples(spark, range(total)), size, hop, True, block_rows)
    got = {r.window_id: r.readings for r in frame.select("window_id", "readings").collect()}
    want = {
        k - 1: [float(v) for v in range(max(0, k * hop - size), k * hop)] for k in range(1, total // hop + 1)
    }
    assert got == want


def _uneven(spark):
    """One device with most rows, bursts in time, equal times, and some small devices."""
    rows = []
    for i in range(600):
        if i < 200:
            t = i * 3600.0
        elif i < 400:
            t = 200 * 3600.0 + (i - 200) * 1e-6
        else:
            t = 300 * 3600.0
        rows.append(("big", at(t), i * 1_000_003, float(i % 37), i % 5 == 0))
    for d in range(5):
        rows += [(f"small{d}", at(i * 7.0), i, float(i), False) for i in range(30)]
    return spark.createDataFrame(rows, SAMPLE_SCHEMA)


@pytest.mark.parametrize("block_rows", [16, 50, 590])
def test_block_numbering_equals_row_number(spark, block_rows):
    frame = _uneven(spark)
    plain, keys, _ = number_rows(frame)
    assert keys == ["device_id"]
    blocks, keys, length = number_rows(frame, hop=4, block_rows=block_rows)
    assert keys == ["device_id", "block"] and length % 4 == 0
    columns = ("device_id", "seq", "pos", "acceleration")
    assert rows_of(blocks, *columns) == rows_of(plain, *columns)
    assert blocks.groupBy(*keys).count().agg(F.max("count")).first()[0] <= length


def test_descending_block_numbering(spark):
    frame = _uneven(spark)
    plain, _, _ = number_rows(frame, descending=True)
    blocks, _, _ = number_rows(frame, descending=True, block_rows=50)
    assert rows_of(blocks, "device_id", "seq", "pos") == rows_of(plain, "device_id", "seq", "pos")


def test_cells_stay_below_the_limit_and_cover_all_rows(spark):
    frame = _uneven(spark)
    major, minor = F.unix_micros("ts").cast("double"), F.col("seq").cast("double")
    split = split_crowded_keys(frame, "device_id", major, minor, 100, 10)
    assert split.cells.agg(F.max("_n"), F.sum("_n")).first()[:][0] <= 20
    assert split.cells.agg(F.sum("_n")).first()[0] == 600
    assert split.rows.count() == frame.count()
    assert split_crowded_keys(frame, "device_id", major, minor, 600, 10) is None


def test_extreme_tie_breaks_do_not_overflow(spark):
    seqs = [-(2**63), -1, 0, 1, 2**62, 2**63 - 1] + [2**40 + i for i in range(40)]
    frame = spark.createDataFrame([("d", at(1.0), s, 1.0, False) for s in seqs], SAMPLE_SCHEMA)
    blocks, _, _ = number_rows(frame, block_rows=8)
    assert [r.seq for r in blocks.orderBy("pos").collect()] == sorted(seqs)


def test_copies_of_a_row_are_all_numbered(spark):
    frame = spark.createDataFrame(
        [("d", at(float(i // 7)), i // 7, float(i // 7), False) for i in range(210)], SAMPLE_SCHEMA
    )
    blocks, _, _ = number_rows(frame, block_rows=20)
    assert [r.pos for r in blocks.orderBy("pos").collect()] == list(range(210))
    assert [r.acceleration for r in blocks.orderBy("pos").collect()] == [float(i // 7) for i in range(210)]


def test_missing_times_sort_first(spark):
    rows = [("d", None if i < 30 else dt.datetime(2026, 1, 1) + dt.timedelta(seconds=i), i, 1.0, False)
            for i in range(80)]
    frame = spark.createDataFrame(rows, SAMPLE_SCHEMA)
    blocks, _, _ = number_rows(frame, block_rows=16)
    assert [r.seq for r in blocks.orderBy("pos").collect()] == list(range(80))


@pytest.mark.parametrize("size, hop", [(16, None), (32, 8)])
def test_features_do_not_depend_on_block_length(spark, sf_dir, size, hop):
    frame = q.crowded_samples(spark, sf_dir)
    columns = ("device_id", "window_id", "n", F.round("rms", 9), F.round("dominant_freq_hz", 12), "ground_truth")
    whole = rows_of(extract_features(frame, size, hop), *columns)
    assert whole
    assert rows_of(extract_features(frame, size, hop, 40), *columns) == whole


def test_crowded_device_needs_one_shuffle_of_the_rows(spark, sf_dir):
    frame = count_window_aggregates(q.crowded_samples(spark, sf_dir), 16, with_array=False, block_rows=64)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    rows_side = [line for line in plan.splitlines() if "Exchange hashpartitioning(device_id" in line and "block" in line]
    assert len(rows_side) <= 2  # the rows, and the small table of block starts
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_crowded_missing_device_is_cut_like_any_other(spark):
    frame = _uneven(spark).withColumn("device_id", F.expr("nullif(device_id, 'big')"))
    plain, _, _ = number_rows(frame)
    blocks, keys, _ = number_rows(frame, block_rows=50)
    assert rows_of(blocks, "device_id", "seq", "pos") == rows_of(plain, "device_id", "seq", "pos")
    assert blocks.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 50


def test_entries_above_the_broadcast_limit_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr("tremorline.operators.blocks.BROADCAST_ROWS", 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = _uneven(spark)
        blocks, _, _ = number_rows(frame, block_rows=50)
        assert "BroadcastHashJoin" not in blocks._jdf.queryExecution().executedPlan().toString()
        plain, _, _ = number_rows(frame, block_rows=1000)
        assert rows_of(blocks, "device_id", "seq", "pos") == rows_of(plain, "device_id", "seq", "pos")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_blocks_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr("tremorline.operators.blocks.BLOCK_ROWS", 10)
    monkeypatch.setattr("tremorline.operators.blocks.BROADCAST_ROWS", 100)
    frame = _uneven(spark)
    blocks, keys, length = number_rows(frame)
    assert keys == ["device_id", "block"] and length == 120  # 750 rows, 2 * 8 entries per block, 100 entries
    assert blocks.count() == 750


def test_ties_have_one_order_on_every_path(spark):
    """Rows equal in time and number: the same ones are the latest, whatever the block size and whoever limits them."""
    rows = [("d", at(i // 40), None if i % 3 else 0, float(i * 7919 % 4000), i % 2 == 0) for i in range(4000)]
    frame = spark.createDataFrame(rows, SAMPLE_SCHEMA)
    names = ("ts", "seq", "acceleration", "ground_truth")
    wanted = rows_of(latest_n(frame, 905), *names)
    assert len(wanted) == 905
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        for block_rows in (256, 1000, None):
            assert rows_of(latest_n(frame, 905, block_rows=block_rows), *names) == wanted
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")

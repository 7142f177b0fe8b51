"""Results do not depend on size, on names, or on who wrote the files."""

import pytest

from pyspark.sql import functions as F
from pyspark.sql import Window as W
from tests.helpers import rows_of, samples
from tests.test_archive import TIME, batch_name, payload, put
from tremorline.operators.backlog import peek_oldest
from tremorline.operators.blocks import number_rows
from tremorline.operators.labels import label_faults
from tremorline.operators.windows import latest_n
from tremorline.plans.detection import detect, detect_time_windows
from tremorline.plans.publishing import archive_batches, backlog, publish
from tremorline.sources.archive import audit_archive, read_archive
from tremorline.sources.lake import list_lake, read_lake, write_lake
from tremorline.functions.payload import window_payloads
from tremorline.streaming import sinks


def test_last_samples_where_times_are_missing(spark, monkeypatch):
    frame = samples(spark, [float(i) for i in range(10)]).withColumn("ts", F.when(F.col("seq") > 2, F.col("ts")))
    small = rows_of(latest_n(frame, 5), "seq")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    try:
        large = rows_of(latest_n(frame, 5, block_rows=3), "seq")
        whole = rows_of(latest_n(frame, 5), "seq")
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert small == large == whole == [(5,), (6,), (7,), (8,), (9,)]


@pytest.mark.parametrize("limit", [0, 10**6])
def test_a_missing_device_has_no_faults(spark, limit):
    frame = samples(spark, [1.0, 2.0, 3.0]).withColumn("device_id", F.when(F.col("seq") == 0, F.col("device_id")))
    schedule = frame.select("device_id", F.col("ts").alias("start_ts"), F.expr("ts + interval 1 day").alias("end_ts"))
    assert rows_of(label_faults(frame, schedule, max_pieces=limit).where("ground_truth"), "seq") == [(0,)]


def test_ties_are_cut_into_cells(spark):
    frame = samples(spark, [float(i % 4000) for i in range(4050)]).withColumns(
        {"ts": F.lit("2026-07-27").cast("timestamp"), "seq": F.lit(1).cast("bigint")}
    )
    numbered, keys, _ = number_rows(frame, block_rows=64)
    assert keys == ["device_id", "block"] and numbered.count() == 4050
    assert sorted(r.pos for r in numbered.collect()) == list(range(4050))
    rest = F.xxhash64("acceleration", "ground_truth")
    full = F.row_number().over(W.partitionBy("device_id").orderBy("ts", "seq", rest, "acceleration", "ground_truth")) - 1
    want = rows_of(frame.select("acceleration", full.alias("pos")), "acceleration", "pos")
    assert rows_of(numbered, "acceleration", "pos") == want


def test_own_files_are_read_by_default(spark, tmp_path):
    path = str(tmp_path / "a")
    archive_batches(detect(samples(spark, [float(i) for i in range(16)]), 4), path)
    assert read_archive(spark, path).count() == audit_archive(spark, path).count() == 4
    put(tmp_path / "a" / "quarantine", batch_name(1), payload())
    put(tmp_path / "a" / "quarantine", batch_name(2), b"broken")
    put(tmp_path / "a", batch_name(3) + ".tmp", payload())
    put(tmp_path / "a", "part-00000.json.gz", b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00" + b"\x00" * 8)
    assert read_archive(spark, path).count() == audit_archive(spark, path).count() == 4


def test_backlog_of_payloads_without_device_or_time(spark, tmp_path):
    put(tmp_path / "a", "batch_9.json.gz", payload(TIME))
    put(tmp_path / "a", "batch_10.json.gz", payload(TIME + 1))
    put(tmp_path / "a", "batch_8.json.gz", {"features": {"rms": 1.0}, "anomaly_detected": True})
    empty = read_lake(spark, str(tmp_path)).limit(0)
    waiting, bad = backlog(spark, str(tmp_path / "a"), empty, device_id="edge")
    assert rows_of(waiting, "device_id", "batch_id", "queue_position") == [("edge", "batch_10.json.gz", 1), ("edge", "batch_9.json.gz", 2)]
    assert rows_of(bad, "reason") == [("no timestamp",)]
    assert peek_oldest(waiting).first().batch_id == "batch_10.json.gz"
    waiting, bad = backlog(spark, str(tmp_path / "a"), empty, device_id="edge", date_undated=True)
    assert waiting.count() == 3 and bad.count() == 0
    lake = str(tmp_path / "lake")
    archive = sinks.stream_archive(spark, str(tmp_path / "a"))
    sinks.sync_to_lake(archive, lake, str(tmp_path / "c"), "edge", date_undated=True).awaitTermination()
    for device, left in (("edge", 0), (None, 3)):
        waiting, _ = backlog(spark, str(tmp_path / "a"), read_lake(spark, lake), device_id=device, date_undated=True)
        assert waiting.count() == left


def test_stream_and_batch_share_a_lake(spark, tmp_path):
    windows = detect(samples(spark, [float(i) for i in range(32)]), 4)
    lake = str(tmp_path / "lake")
    archive_batches(windows.where("window_id < 4"), str(tmp_path / "a"))
    sinks.sync_to_lake(sinks.stream_archive(spark, str(tmp_path / "a")), lake, str(tmp_path / "c")).awaitTermination()
    assert publish(windows.where("window_id >= 2"), lake).count() == 8


def test_listing_counts_what_was_written(spark, tmp_path):
    windows = detect(samples(spark, [float(i) for i in range(16)]).withColumn("device_id", F.lit("a:b c+d")), 4)
    write_lake(window_payloads(windows), str(tmp_path / "lake"), max_records=1)
    files = list((tmp_path / "lake").rglob("*.json.gz"))
    listed = list_lake(spark, str(tmp_path / "lake")).collect()
    assert [(r.device_id, r.month, r.n_files, r.n_bytes) for r in listed] == [
        ("a:b c+d", "07", len(files), sum(f.stat().st_size for f in files))
    ]
    assert read_lake(spark, str(tmp_path / "lake")).first().device_id == "a:b c+d"


def test_time_windows_become_payloads(spark, tmp_path):
    frame = samples(spark, [float(i % 5) for i in range(3000)], times=[i / 1000 for i in range(3000)])
    windows = detect_time_windows(frame, "1 second")
    counted = detect(frame, 1000)
    names = ("n", "round(rms, 9)", "round(mean, 9)", "round(std, 9)", "round(dominant_freq_hz, 6)", "anomaly_detected")
    assert rows_of(windows, *names) == rows_of(counted, *names)
    assert publish(windows, str(tmp_path / "lake")).count() == 3

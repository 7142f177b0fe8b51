import gzip
import json
import os

import pytest

from pyspark.sql import functions as F
from tests.helpers import at, rows_of, samples
from tremorline.functions.keys import batch_id, object_key, partition_values, utc_timestamp
from tremorline.functions.payload import encode_payload, window_payloads
from tremorline.operators.backlog import (
    dedupe_redelivery,
    fifo_order,
    peek_oldest,
    pending_batches,
    queue_depth,
)
from tremorline.plans.detection import detect
from tremorline.plans.publishing import archive_batches, backlog, publish
from tremorline.sources.archive import (
    audit_archive,
    fill_missing_time,
    missing_batches,
    parse_records,
    read_archive,
    split_quarantine,
)
from tremorline.sources.lake import list_lake, read_lake, write_lake

TIME = 1785110400.0


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    body = content if isinstance(content, bytes) else gzip.compress(json.dumps(content).encode())
    (folder / name).write_bytes(body)


def payload(timestamp=TIME, rms=1.5):
    return {"timestamp": timestamp, "features": {"rms": rms}, "anomaly_detected": False, "ground_truth": False}


def batch_name(number):
    return f"batch_{number:019d}.json.gz"


def test_object_key(spark):
    frame = spark.createDataFrame([(TIME, "sensor-node-01", "batch_12345.json.gz")], "t double, d string, b string")
    ts = utc_timestamp(F.col("t"))
    row = frame.select(object_key(ts, F.col("d"), F.col("b")).alias("key"), *partition_values(ts)).first()
    assert row.key == "year=2026/month=07/day=27/device_id=sensor-node-01/batch_12345.json.gz"
    assert (row.year, row.month, row.day) == ("2026", "07", "27")


def test_batch_id_sorts_by_time_then_window(spark):
    frame = spark.createDataFrame([(at(1), 9), (at(1), 10), (at(0.5), 11)], "t timestamp, w bigint")
    ids = [r.b for r in frame.select(batch_id(F.col("t"), F.col("w")).alias("b"), "w").orderBy("b").collect()]
    assert [i.split("_")[2][:10] for i in ids] == ["0000000011", "0000000009", "0000000010"]
    assert ids[0] == "batch_1785110400500000000_0000000011.json.gz"


def test_payload_text_has_the_expected_fields(spark):
    windows = detect(samples(spark, [1.0, -1.0, 1.0, -1.0]), 4)
    text = window_payloads(windows).select(encode_payload()).first()[0]
    body = json.loads(text)
    assert set(body) == {"timestamp", "features", "anomaly_detected", "ground_truth"}
    assert set(body["features"]) == {"rms", "mean", "std", "dominant_freq_hz"}
    assert body["timestamp"] == TIME + 0.003 and body["features"]["rms"] == 1.0


def test_archive_scan_sees_finished_batches_only(spark, tmp_path):
    put(tmp_path / "q", batch_name(2), payload(TIME + 1, 2.5))
    put(tmp_path / "q", batch_name(1), payload())
    put(tmp_path / "q", batch_name(3) + ".tmp", payload())
    put(tmp_path / "q", "notes.json.gz", payload())
    rows = read_archive(spark, str(tmp_path / "q")).orderBy("batch_id").collect()
    assert [(r.batch_id, r.timestamp, r.features.rms) for r in rows] == [
        (batch_name(1), TIME, 1.5),
        (batch_name(2), TIME + 1, 2.5),
    ]


def test_broken_batches_are_set_aside_and_the_rest_goes_on(spark, tmp_path):
    folder = tmp_path / "q"
    put(folder, batch_name(0), b"\x00 neither zipped nor JSON")
    put(folder, batch_name(1), payload())
    put(folder, batch_name(2), gzip.compress(b'{"timestamp": 1785'))
    put(folder, batch_name(3), {})
    put(folder, batch_name(4), [1, 2])
    put(folder, batch_name(5), payload("yesterday"))
    put(folder, batch_name(6), {"features": {"rms": 1.0}})
    put(folder, batch_name(7), gzip.compress(b""))
    put(folder, batch_name(8), gzip.compress(json.dumps(payload()).encode())[:-9])
    put(folder, batch_name(9), gzip.compress(b"\xff\xfe"))
    put(folder, batch_name(10), b"")
    put(folder / "quarantine", batch_name(11), b"NOT")
    put(folder, batch_name(12), gzip.compress(b'{"timestamp": 1785110400, "features": {"rms": NaN}, "other": [1]}'))
    put(folder, batch_name(13), gzip.compress(b"plain words"))
    audited = audit_archive(spark, str(folder)).cache()
    good, bad = split_quarantine(audited)
    assert rows_of(good, "batch_id", "timestamp") == [(batch_name(1), TIME), (batch_name(12), TIME)]
    assert dict(rows_of(bad, "file_name", "reason")) == {
        batch_name(0): "not gzip",
        batch_name(2): "not json",
        batch_name(3): "no fields",
        batch_name(4): "not an object",
        batch_name(5): "wrong type",
        batch_name(6): "no timestamp",
        batch_name(7): "empty",
        batch_name(8): "not gzip",
        batch_name(9): "not utf-8",
        batch_name(13): "not json",
    }
    expected = spark.createDataFrame([(batch_name(i),) for i in range(11)], "file_name string")
    assert rows_of(missing_batches(expected, audited), "file_name") == [(batch_name(10),)]


def test_undated_records_can_take_the_time_of_their_file(spark, tmp_path):
    put(tmp_path / "q", batch_name(1), {"features": {"rms": 1.0}})
    put(tmp_path / "q", batch_name(2), payload())
    put(tmp_path / "q", batch_name(3), {})
    os.utime(tmp_path / "q" / batch_name(1), (TIME + 86_400, TIME + 86_400))
    good, bad = split_quarantine(fill_missing_time(audit_archive(spark, str(tmp_path / "q"))))
    assert rows_of(good, "batch_id", "timestamp") == [(batch_name(1), TIME + 86_400), (batch_name(2), TIME)]
    assert rows_of(bad, "file_name", "reason") == [(batch_name(3), "no fields")]


def test_many_records_in_one_file(spark, tmp_path):
    lines = "\n".join(json.dumps({**payload(TIME + i), "batch_id": f"b{i}", "device_id": "d"}) for i in range(50))
    put(tmp_path / "q", batch_name(1), gzip.compress((lines + "\n{broken\n").encode()))
    good, bad = split_quarantine(audit_archive(spark, str(tmp_path / "q")))
    assert good.count() == 50 and good.select("batch_id").distinct().count() == 50
    assert rows_of(bad, "record", "reason") == [("{broken", "not json")]


def test_fifo_peek_and_depth(spark, tmp_path):
    folder = tmp_path / "q"
    for number in (30, 10, 20):
        put(folder, batch_name(number), payload(TIME + number))
    none_synced = spark.createDataFrame([], "device_id string, batch_id string")

    def waiting(synced):
        good, _ = split_quarantine(audit_archive(spark, str(folder)))
        return pending_batches(good.withColumn("device_id", F.lit("edge-01")), synced)

    queue = waiting(none_synced)
    assert peek_oldest(queue).first().batch_id == batch_name(10)
    assert queue_depth(queue).first().depth == 3
    # A new reader finds the same queue; a synced batch leaves it and unknown ids change nothing.
    synced = spark.createDataFrame([("edge-01", batch_name(10)), ("edge-01", "nope")], none_synced.schema)
    assert peek_oldest(waiting(synced)).first().batch_id == batch_name(20)
    assert queue_depth(waiting(synced)).first().depth == 2
    drained = spark.createDataFrame([("edge-01", batch_name(n)) for n in (10, 20, 30)], none_synced.schema)
    assert waiting(drained).count() == 0 and peek_oldest(waiting(drained)).count() == 0


@pytest.mark.parametrize("n_ranges", [None, 1, 7])
def test_fifo_order_of_any_ids(spark, n_ranges):
    """Ids that share their beginning, of a crowded device, of a missing one, and a missing id."""
    rows = [("d", f"batch_2026-0{7 + i % 2}-{i * 7919 % 4001}") for i in range(3000)]
    rows += [(None, f"x{i}") for i in range(20)] + [("e", None), ("e", ""), ("e", "é"), ("e", "Z"), ("e", "a")]
    frame = spark.createDataFrame(rows, "device_id string, batch_id string").withColumn("other", F.lit(1))
    got = fifo_order(frame, n_ranges)
    assert got.columns == ["device_id", "batch_id", "other", "queue_position"]
    expected = []
    for device in ("d", "e", None):
        ids = sorted((b for d, b in rows if d == device), key=lambda b: (b is not None, (b or "").encode()))
        expected += [(device, b, k + 1) for k, b in enumerate(ids)]
    assert rows_of(got, "device_id", "batch_id", "queue_position") == sorted(expected, key=repr)


def test_redelivery_keeps_the_last_copy(spark):
    frame = spark.createDataFrame(
        [("d", "b1", 1, "x"), ("d", "b1", 2, "y"), ("e", "b1", 1, "z"), ("d", "b2", 1, "w")],
        "device_id string, batch_id string, delivery int, body string",
    )
    kept = dedupe_redelivery(frame, F.col("delivery"))
    assert rows_of(kept, "device_id", "batch_id", "body") == [("d", "b1", "y"), ("d", "b2", "w"), ("e", "b1", "z")]
    assert dedupe_redelivery(frame).count() == 3


def test_windows_of_two_devices_with_the_same_end_stay_apart(spark, tmp_path):
    both = samples(spark, [1.0] * 4, device="a").unionByName(samples(spark, [2.0] * 4, device="b"))
    lake = publish(detect(both, 4), str(tmp_path / "lake"))
    assert rows_of(lake, "device_id", "month", "features.rms") == [("a", "07", 1.0), ("b", "07", 2.0)]
    assert lake.select("batch_id").distinct().count() == 1


def test_lake_is_gzip_in_dated_folders_and_prunes(spark, tmp_path):
    days = samples(spark, range(40), times=[i * 43_200.0 for i in range(40)])
    path = str(tmp_path / "lake")
    lake = publish(detect(days, 4), path)
    assert lake.count() == 10
    files = [str(p.relative_to(path)) for p in (tmp_path / "lake").rglob("*.json.gz")]
    assert any(f.startswith("year=2026/month=07/day=28/device_id=d1/part-") for f in files)
    one_month = read_lake(spark, path).where("year = '2026' and month = '08'")
    plan = one_month._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "month" in filters
    assert 0 < one_month.count() < 10
    listed = list_lake(spark, path)
    assert listed.agg(F.sum("n_files")).first()[0] == len(files)
    assert listed.where("month = '07' and n_bytes > 0").count() > 0


def test_publishing_again(spark, tmp_path):
    windows = detect(samples(spark, range(8), times=[i * 43_200.0 for i in range(8)]), 2)
    path = str(tmp_path / "lake")
    publish(windows, path)
    twice = publish(windows, path)
    assert (twice.count(), dedupe_redelivery(twice).count()) == (4, 4)
    last_day = windows.where("window_id = 3")
    write_lake(window_payloads(last_day), path)
    assert read_lake(spark, path).count() == 4


def test_rewriting_one_window_keeps_the_rest_of_its_folder(spark, tmp_path):
    windows = detect(samples(spark, range(8)), 2)
    path = str(tmp_path / "lake")
    publish(windows, path)
    again = windows.where("window_id = 3").withColumn("rms", F.lit(-1.0))
    assert sorted(r.features.rms == -1.0 for r in publish(again, path).collect()) == [False, False, False, True]


def test_backlog_view(spark, tmp_path):
    windows = detect(samples(spark, range(40)), 4)
    archive_batches(windows, str(tmp_path / "archive"))
    put(tmp_path / "archive", "part-broken.json.gz", b"NOT")
    lake = publish(windows.where("window_id < 6"), str(tmp_path / "lake"))
    waiting, bad = backlog(spark, str(tmp_path / "archive"), lake, "part-*.json.gz")
    rows = waiting.orderBy("queue_position").collect()
    assert [(int(r.batch_id[-18:-8]), r.queue_position) for r in rows] == [(6, 1), (7, 2), (8, 3), (9, 4)]
    assert rows_of(bad, "file_name", "reason") == [("part-broken.json.gz", "not gzip")]


@pytest.mark.parametrize("text, reason", [(" {} ", "no fields"), ('"x"', "not an object"), ("5", "not an object"),
                                          ("{", "not json"), ('{"timestamp": 1}', None),
                                          ('{"timestamp": null}', "no timestamp"), ("null", "not an object")])
def test_record_reasons(spark, text, reason):
    frame = spark.createDataFrame([(text,)], "record string")
    assert parse_records(frame).first().reason == reason

import gzip
import json
import random
import shutil

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F
from tests.helpers import at, rows_of, samples
from tremorline.model import FAULT_SCHEMA, SAMPLE_SCHEMA
from tremorline.operators.detect import classification_metrics, confusion_counts
from tremorline.operators.features import extract_features
from tremorline.operators.labels import label_fault_stream, label_faults
from tremorline.plans.detection import detect
from tremorline.sources.archive import with_event_time
from tremorline.sources.lake import read_lake
from tremorline.sources.samples import read_sample_stream
from tremorline.streaming import batch_windows, count_windows, sinks
from tremorline.streaming.batch_windows import count_windows_by_batch
from tremorline.streaming.count_windows import cut_windows, cut_windows_in_order, stream_count_windows, stream_detect
from tremorline.streaming.time_windows import stream_time_windows

COLUMNS = ("device_id", "window_id", "n", "round(rms, 9)", "round(mean, 9)", "round(std, 9)", "window_start",
           "window_end", "round(dominant_freq_hz, 9)", "ground_truth")


def signal(spark, n=100):
    rng = np.random.default_rng(1)
    a = samples(spark, rng.normal(0, 2, n).round(3), device="a", truth=[i % 7 == 0 for i in range(n)])
    return a.unionByName(samples(spark, rng.normal(0, 1, n // 2).round(3), device="b"))


def write_parts(frame, path, cuts):
    """One Parquet file per range of ``seq``, as if they had arrived one after the other."""
    for low, high in zip([0, *cuts], [*cuts, 10**9]):
        part = frame.where((F.col("seq") >= low) & (F.col("seq") < high)).toPandas()
        part["ts"] = part["ts"].astype("datetime64[us]").dt.tz_localize("UTC")
        part.to_parquet(f"{path}/part-{low:09d}.parquet")


@pytest.mark.parametrize("size, hop", [(16, None), (12, 5), (4, 9)])
def test_stream_equals_batch_over_several_micro_batches(spark, tmp_path, size, hop):
    frame = signal(spark)
    (tmp_path / "in").mkdir()
    write_parts(frame, tmp_path / "in", [1, 13, 14, 40, 77])
    stream = read_sample_stream(spark, str(tmp_path / "in"), SAMPLE_SCHEMA, max_files=1)
    windows = stream_count_windows(stream, size, hop)
    sinks.write_windows(windows, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = rows_of(spark.read.parquet(str(tmp_path / "out")), *COLUMNS)
    assert got == rows_of(extract_features(frame, size, hop), *COLUMNS)


@pytest.mark.parametrize("size, hop, block_rows", [(16, 16, 4_000_000), (12, 5, 10)])
def test_micro_batches_through_the_batch_operators(spark, tmp_path, size, hop, block_rows):
    frame = signal(spark)
    (tmp_path / "in").mkdir()
    out, state, checkpoint = (str(tmp_path / name) for name in ("out", "state", "c"))
    write_parts(frame, tmp_path / "in", [1, 14, 40, 77])

    def run():
        stream = read_sample_stream(spark, str(tmp_path / "in"), SAMPLE_SCHEMA, max_files=1)
        count_windows_by_batch(stream, size, out, state, checkpoint, hop, block_rows=block_rows).awaitTermination()

    run()
    expected = rows_of(extract_features(frame, size, hop), *COLUMNS)
    assert rows_of(spark.read.parquet(out), *COLUMNS) == expected
    # A crash before the last commit makes Spark hand the last micro-batch over again.
    commits = sorted((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    assert len(commits) == 5
    copy = tmp_path / "c2"
    shutil.copytree(tmp_path / "c", copy, ignore=lambda d, names: [
        n for n in names if d.endswith("commits") and n.strip(".").startswith(commits[-1].name)])
    checkpoint = str(copy)
    run()
    assert rows_of(spark.read.parquet(out), *COLUMNS) == expected


def test_null_devices_and_times_in_micro_batches(spark, tmp_path, monkeypatch):
    """Readings without a device have windows too; readings without a time come first in both forms."""
    monkeypatch.setattr(batch_windows, "COMPACT_EVERY", 2)
    frame = samples(spark, [float(i) for i in range(40)])
    frame = frame.withColumn("device_id", F.when(F.col("seq") % 2 == 0, F.col("device_id")))
    (tmp_path / "in").mkdir()
    for low in range(0, 40, 8):
        frame.where((F.col("seq") >= low) & (F.col("seq") < low + 8)).write.mode("append").parquet(str(tmp_path / "in"))
        stream = read_sample_stream(spark, str(tmp_path / "in"), SAMPLE_SCHEMA, max_files=1000)
        out, state, checkpoint = (str(tmp_path / n) for n in ("out", "state", "c"))
        count_windows_by_batch(stream, 6, out, state, checkpoint, 3).awaitTermination()
    assert rows_of(spark.read.parquet(out), *COLUMNS) == rows_of(extract_features(frame, 6, 3), *COLUMNS)

    untimed = samples(spark, [float(i) for i in range(20)], device="u").withColumn("ts", F.when(F.col("seq") > 2, F.col("ts")))
    untimed.write.parquet(str(tmp_path / "in2"))
    stream = read_sample_stream(spark, str(tmp_path / "in2"), SAMPLE_SCHEMA)
    count_windows_by_batch(stream, 8, f"{out}2", f"{state}2", f"{checkpoint}2").awaitTermination()
    expected = {r.window_id: r["mean"] for r in extract_features(untimed, 8).collect()}
    assert {r.window_id: r["mean"] for r in spark.read.parquet(f"{out}2").collect()} == expected == {0: 3.5, 1: 11.5}


def test_micro_batch_touches_its_own_devices(spark, tmp_path):
    many = samples(spark, [float(i) for i in range(600)]).withColumn("device_id", F.format_string("d%d", F.col("seq") % 200))
    (tmp_path / "in").mkdir()
    out, state, checkpoint = (str(tmp_path / n) for n in ("out", "state", "c"))

    def run():
        stream = read_sample_stream(spark, str(tmp_path / "in"), SAMPLE_SCHEMA, max_files=1000)
        count_windows_by_batch(stream, 4, out, state, checkpoint).awaitTermination()

    many.write.mode("append").parquet(str(tmp_path / "in"))
    run()
    one = samples(spark, [1.0], times=[5000.0]).withColumns({"device_id": F.lit("d7"), "seq": F.lit(9999).cast("bigint")})
    one.write.mode("append").parquet(str(tmp_path / "in"))
    run()
    schemas = {"seen": batch_windows.SEEN, "tail": batch_windows.TAIL}
    written = {n: spark.read.schema(s).parquet(f"{state}/kept/{n}/added=1") for n, s in schemas.items()}
    assert {name: [r.device_id for r in rows.collect()] for name, rows in written.items()} == {"seen": ["d7"], "tail": []}
    assert [(r.device_id, r.window_id) for r in spark.read.parquet(out).collect()] == [("d7", 0)]


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    frame = signal(spark)
    (tmp_path / "in").mkdir()

    def run():
        stream = read_sample_stream(spark, str(tmp_path / "in"), SAMPLE_SCHEMA)
        windows = stream_detect(stream, 16, rms_threshold=1.5, std_threshold=1.5)
        sinks.write_windows(windows, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    write_parts(frame.where("seq < 50"), tmp_path / "in", [])
    assert run().count() == 6
    later = frame.where("seq >= 50").toPandas()
    later["ts"] = later["ts"].astype("datetime64[us]").dt.tz_localize("UTC")
    later.to_parquet(tmp_path / "in" / "part-later.parquet")
    columns = (*COLUMNS, "anomaly_detected")
    assert rows_of(run(), *columns) == rows_of(detect(frame, 16, rms_threshold=1.5, std_threshold=1.5), *columns)
    assert run().count() == 9


def test_state_stays_bounded():
    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    state, emitted = State(), 0
    for start in range(0, 5000, 37):
        part = pd.DataFrame({"ts_us": range(start, start + 37), "seq": range(start, start + 37),
                             "acceleration": 1.0, "ground_truth": False})
        emitted += sum(len(w) for w in cut_windows(("d",), [part], state, size=20, hop=8))
        assert len(state.get[1]) < 28
    assert emitted == state.get[0] // 8


def test_late_samples_are_dropped_after_the_watermark(spark, tmp_path):
    (tmp_path / "in").mkdir()
    times = [0.1, 0.2, 1.5, 9.0, 9.2, 0.3, 9.5, 30.0]
    frame = samples(spark, range(len(times)), times=times)
    write_parts(frame, tmp_path / "in", [3, 4, 5, 7])
    stream = read_sample_stream(spark, str(tmp_path / "in"), SAMPLE_SCHEMA, max_files=1)
    windows = stream_time_windows(stream, "1 second", "2 seconds")
    sinks.write_windows(windows, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select(
        (F.unix_seconds("interval_start") - int(at(0).timestamp())).alias("s"), "n"
    )
    # The sample at 0.3 s arrives when the watermark has passed 7 s; the window of 30 s is still open.
    assert rows_of(got, "s", "n") == [(0, 2), (1, 1), (9, 3)]


def test_archive_to_lake_and_quarantine(spark, tmp_path):
    queue = tmp_path / "queue"
    queue.mkdir()

    def put(number, body):
        (queue / f"batch_{number:019d}.json.gz").write_bytes(body)

    def good(number):
        body = {"timestamp": 1785110400.0 + number, "features": {"rms": 1.5}, "anomaly_detected": True,
                "ground_truth": False}
        put(number, gzip.compress(json.dumps(body).encode()))

    def sync():
        archive = sinks.stream_archive(spark, str(queue), max_files=2)
        sinks.sync_to_lake(archive, str(tmp_path / "lake"), str(tmp_path / "c1"), "edge-01").awaitTermination()
        sinks.quarantine(archive, str(tmp_path / "bad"), str(tmp_path / "c2")).awaitTermination()

    put(0, b"\x00 neither zipped nor JSON")
    for number in (1, 2, 3):
        good(number)
    sync()
    good(4)
    put(5, gzip.compress(b"{}"))
    sync()
    sync()
    lake = read_lake(spark, str(tmp_path / "lake"))
    assert rows_of(lake, "device_id", "year", "day", "batch_id") == [
        ("edge-01", "2026", "27", f"batch_{n:019d}.json.gz") for n in (1, 2, 3, 4)
    ]
    assert rows_of(spark.read.parquet(str(tmp_path / "bad")), "file_name", "reason") == [
        (f"batch_{0:019d}.json.gz", "not gzip"), (f"batch_{5:019d}.json.gz", "no fields")
    ]
    # One query for both, that puts files together after every micro-batch.
    archive = sinks.stream_archive(spark, str(queue), max_files=2)
    sinks.sync_to_lake(archive, str(tmp_path / "lake2"), str(tmp_path / "c3"), "edge-01", compact_every=1,
                       quarantine_path=str(tmp_path / "bad2")).awaitTermination()
    assert rows_of(read_lake(spark, str(tmp_path / "lake2")), "*") == rows_of(lake, "*")
    both = [rows_of(spark.read.parquet(str(tmp_path / name)), "file_name", "reason") for name in ("bad", "bad2")]
    assert both[0] == both[1]


def test_queue_then_sync(spark, tmp_path):
    frame = signal(spark)
    (tmp_path / "in").mkdir()
    write_parts(frame, tmp_path / "in", [30, 60])
    windows = stream_detect(read_sample_stream(spark, str(tmp_path / "in"), SAMPLE_SCHEMA, 1), 16)
    sinks.queue_windows(windows, str(tmp_path / "q"), str(tmp_path / "c1")).awaitTermination()
    archive = sinks.stream_archive(spark, str(tmp_path / "q"), "part-*.json.gz")
    sinks.sync_to_lake(archive, str(tmp_path / "lake"), str(tmp_path / "c2")).awaitTermination()
    lake = read_lake(spark, str(tmp_path / "lake"))
    batch = detect(frame, 16)
    assert rows_of(lake, "device_id", F.round("features.rms", 9).alias("r"), "anomaly_detected") == rows_of(
        batch, "device_id", F.round("rms", 9).alias("r"), "anomaly_detected"
    )


def test_redelivered_batches_are_dropped_from_the_stream(spark, tmp_path):
    queue = tmp_path / "queue"
    queue.mkdir()
    for name in ("batch_1", "batch_2"):
        lines = [json.dumps({"timestamp": 1785110400.0 + i, "batch_id": f"b{i}", "device_id": "d"}) for i in range(3)]
        (queue / f"{name}.json.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    archive = with_event_time(sinks.stream_archive(spark, str(queue), max_files=1).where("reason is null"))
    once = sinks.dedupe_stream(archive, "1 hour").select("device_id", "batch_id")
    sinks.write_windows(once, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert rows_of(spark.read.parquet(str(tmp_path / "out")), "batch_id") == [("b0",), ("b1",), ("b2",)]


def test_running_metrics_follow_the_windows(spark, tmp_path):
    frame = detect(signal(spark), 16, rms_threshold=1.5, std_threshold=1.5)
    columns = ["device_id", "window_id", "anomaly_detected", "ground_truth"]
    path = str(tmp_path / "windows")
    seen = []
    for low, high in ((0, 3), (3, 99)):
        frame.where(f"window_id >= {low} and window_id < {high}").select(*columns).write.mode("append").parquet(path)
        stream = spark.readStream.schema(frame.select(*columns).schema).parquet(path)
        sinks.running_metrics(stream, str(tmp_path / "m"), str(tmp_path / "c")).awaitTermination()
        seen.append(spark.read.parquet(str(tmp_path / "m")).first().total_windows)
    assert seen == [6, 9]
    row = spark.read.parquet(str(tmp_path / "m")).first()
    assert row.asDict() == classification_metrics(confusion_counts(frame)).first().asDict()


class Kept:
    """State as the operator sees it."""

    def __init__(self):
        self.value = None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value


def in_order(parts, size, hop, lateness_us):
    """Windows and late samples of one device over micro-batches of (ts_us, seq, value)."""
    state, windows, late = Kept(), [], []
    for part in parts:
        frame = pd.DataFrame([(t, s, float(v), bool(v % 2)) for t, s, v in part], columns=["ts_us", "seq", "acceleration", "ground_truth"])
        for out in cut_windows_in_order(("d",), [frame] if part else [], state, size, hop, lateness_us):
            for row in out.to_dict("records"):
                (late if not pd.isna(row["late_seq"]) else windows).append(row)
    return windows, late, state


@pytest.mark.parametrize("size,hop", [(8, 8), (8, 3), (4, 6)])
def test_order_of_arrival_does_not_matter_within_the_lateness(size, hop):
    """Shuffled inside the lateness, in many small micro-batches: the windows of the sorted samples."""
    rnd = random.Random(size + hop)
    ordered = [(1000 * i // 2, i, i * i % 17) for i in range(400)]
    shuffled = sorted(ordered, key=lambda row: row[0] + rnd.randint(0, 5000))
    parts = [shuffled[i : i + 7] for i in range(0, 400, 7)]
    parts.insert(5, [])
    windows, late, state = in_order(parts, size, hop, 6000)
    released = [row for row in ordered if row[0] <= max(r[0] for r in ordered) - 6000]
    expected = [
        (k, len(part), sum(v for *_, v in part) / len(part), part[-1][0])
        for k in range(len(released) // hop)
        for part in [released[max(0, (k + 1) * hop - size) : (k + 1) * hop]]
    ]
    assert [(w["window_id"], w["n"], w["mean"], w["end_us"]) for w in windows] == [pytest.approx(e) for e in expected]
    assert not late and len(state.value[2]) < size + hop and len(state.value[6]) == 400 - len(released)


def test_late_samples_come_back_as_they_are():
    windows, late, state = in_order([[(10_000, 1, 3)], [(0, 2, 5), (9_999, 3, 1)], [(50_000, 4, 2)], [(40_000, 5, 7), (41_000, 6, 9)]], 2, 2, 9_500)
    # 10 000 - 9 500: the sample at 0 is late, the one at 9 999 is not; later, 40 000 is below 50 000 - 9 500.
    assert [(r["late_ts_us"], r["late_seq"], r["late_acceleration"], r["late_ground_truth"]) for r in late] == [(0, 2, 5.0, True), (40_000, 5, 7.0, True)]
    assert [(w["n"], w["mean"]) for w in windows] == [(2, 2.0)] and all(w["device_id"] == "d" for w in windows + late)
    assert state.value[1] == 40_500 and list(state.value[7]) == [6, 4]


def test_due_windows_are_reduced_in_slices(monkeypatch):
    """Many windows due at once are emitted in frames of a bounded number of readings."""
    monkeypatch.setattr(count_windows, "CELLS", 64)
    frame = pd.DataFrame({"ts_us": range(1000), "seq": range(1000), "acceleration": np.arange(1000.0), "ground_truth": False})
    frames = list(cut_windows(("d",), [frame], Kept(), 16, 4))
    assert max(len(f) for f in frames) == 4 and [i for f in frames for i in f.window_id] == list(range(250))


def test_faults_on_a_stream(spark, tmp_path):
    """Overlapping, late and missing faults: each sample once, labelled as the batch labels it."""
    values = [float(i) for i in range(60)]
    rows = samples(spark, values, rate=1.0).unionByName(samples(spark, values, rate=1.0, device="e"))
    schedule = [("d1", at(5), at(9)), ("d1", at(7), at(12)), ("e", at(20), at(20)), ("x", at(1), at(30)), ("d1", at(30), at(25)), (None, at(1), at(50)), ("e", at(33), None)]
    faults = spark.createDataFrame(schedule, FAULT_SCHEMA)
    for name, frame, time in (("s", rows, "ts"), ("f", faults, "start_ts")):
        (tmp_path / name).mkdir()
        for number, (low, high) in enumerate(((0, 15), (15, 40), (40, 99))):
            frame.where((F.col(time) >= F.lit(at(low))) & (F.col(time) < F.lit(at(high)))).coalesce(1).write.parquet(str(tmp_path / name / f"part={number}"))
    for again in range(2):
        streams = [
            spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name / "part=*"))
            for name, schema in (("s", SAMPLE_SCHEMA), ("f", FAULT_SCHEMA))
        ]
        labelled = label_fault_stream(*streams, "5 seconds", "10 seconds")
        sinks.write_windows(labelled, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    settled = F.col("ts") < F.lit(at(15))
    assert got.count() == got.select("device_id", "seq").distinct().count()
    expected = label_faults(rows, faults)
    assert rows_of(got.where(settled), "device_id", "seq", "ground_truth") == rows_of(expected.where(settled), "device_id", "seq", "ground_truth")
    assert got.where("ground_truth").count() == expected.where("ground_truth").count() == 9

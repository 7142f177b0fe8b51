"""Lakes of many folders: listed and read by tasks, with the rows that Spark's reader gives."""

import bz2
import gzip
import io
import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows_of, samples
from tremorline.functions.payload import window_payloads
from tremorline.plans.detection import detect
from tremorline.plans.publishing import archive_batches, backlog, publish
from tremorline.sources import lake_files
from tremorline.sources.lake import compact_lake, list_lake, read_lake, write_lake
from tremorline.streaming import sinks

COLUMNS = ["year", "month", "day", "device_id", "batch_id", "timestamp", "to_json(features)", "anomaly_detected", "ground_truth"]
NAMES = ["a", "b=c/d", "50% é {x}", "", "p", None]


@pytest.fixture
def many(monkeypatch):
    """Every lake has many folders."""
    monkeypatch.setattr(lake_files, "FEW_FOLDERS", 0)


def windows_of(spark, n=6, names=NAMES):
    """Windows of several devices, two days each."""
    times = [i * 43_200.0 / n for i in range(4 * n)]
    one = detect(samples(spark, [float(i % 7) for i in range(4 * n)], times=times), 4)
    devices = spark.createDataFrame([(d,) for d in names], "device string")
    return one.crossJoin(devices).withColumn("device_id", F.col("device")).drop("device").cache()


def both_ways(monkeypatch, ask):
    found = []
    for limit in (0, 10**9):
        monkeypatch.setattr(lake_files, "FEW_FOLDERS", limit)
        found.append(ask())
    return found


def test_listing_by_tasks_is_that_of_spark(spark, tmp_path, monkeypatch):
    """Names and sizes of files, odd devices, files that readers pass over and empty ones included."""
    path = tmp_path / "lake"
    write_lake(window_payloads(windows_of(spark)), str(path), max_records=2)
    folder = path / "year=2026/month=07/day=27/device_id=a"
    for name, body in (("_hidden.json.gz", b"x"), (".part.json.gz", b"x"), ("zero.json.gz", b""), ("plain.json", b"{}\n"), ("x._COPYING_", b"x")):
        (folder / name).write_bytes(body)
    monkeypatch.setattr(lake_files, "FOLDERS_PER_TASK", 2)
    mine, theirs = both_ways(monkeypatch, lambda: rows_of(list_lake(spark, str(path)), "*"))
    assert mine == theirs and len(mine) >= 10
    told = F.replace("file_path", F.lit("file:/"), F.lit("/"))
    sizes = both_ways(monkeypatch, lambda: rows_of(
        read_lake(spark, str(path), files=True).where("device_id IN ('a', 'p')"), "device_id", told, "file_size"))
    assert sizes[0] == sizes[1] and len(sizes[0]) >= 5


def test_reading_by_tasks_is_that_of_spark(spark, tmp_path, monkeypatch):
    """Several zipped bodies in a file, other ends of lines, lines that are blank, cut or of another type."""
    path = tmp_path / "lake"
    write_lake(window_payloads(windows_of(spark)), str(path))
    folder = path / "year=2026/month=07/day=28/device_id=a"
    line = json.dumps({"batch_id": "é", "timestamp": 1.5, "features": {"rms": "NaN"}, "year": "1"}, ensure_ascii=False).encode()
    (folder / "two.json.gz").write_bytes(gzip.compress(line + b"\n\n  \n") + gzip.compress(line + b"\r\n" + line + b"\r" + line))
    (folder / "odd.json").write_bytes(b'{"batch_id": "cut", "time\n{"batch_id": "typed", "timestamp": "x"}\n{}\n')
    (folder / "other.json.bz2").write_bytes(bz2.compress(line))
    mine, theirs = both_ways(monkeypatch, lambda: rows_of(read_lake(spark, str(path)), *COLUMNS))
    assert mine == theirs and sum(r[4] == "é" for r in mine) == 5


def test_a_lake_of_many_folders_is_not_listed_by_the_driver(spark, tmp_path):
    """What was written is read back, and no plan holds the files."""
    names = [f"d{i}" for i in range(lake_files.FEW_FOLDERS + 1)]
    windows, path = windows_of(spark, 1, names), str(tmp_path / "lake")
    lake = publish(windows, path)
    assert rows_of(lake, "device_id", "batch_id") == rows_of(window_payloads(windows), "device_id", "batch_id")
    assert "FileIndex" not in lake._jdf.queryExecution().executedPlan().toString()
    assert not list((tmp_path / "lake").rglob(".part-*.json.gz"))
    listed = list_lake(spark, path)
    assert "FileIndex" not in listed._jdf.queryExecution().executedPlan().toString()
    assert listed.agg(F.sum("n_files")).first()[0] == len(names)


def test_a_filter_comes_before_the_listing_and_before_files_are_opened(spark, tmp_path, many):
    path = tmp_path / "lake"
    write_lake(window_payloads(windows_of(spark)), str(path))
    whole = read_lake(spark, str(path)).count()
    for folder in ("day=27/device_id=a", "day=28/device_id=p"):
        (path / "year=2026/month=07" / folder / "part-broken.json.gz").write_bytes(b"NOT")
    day = read_lake(spark, str(path)).where("concat(year, month, day) = '20260728'")
    optimized = day._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("_list(") < optimized.index("20260728")
    assert 0 < day.where("device_id = 'a' OR device_id IS NULL").count() < whole
    for broken in (day, read_lake(spark, str(path)).where("device_id = 'a'")):
        with pytest.raises(Exception, match="(?s)zlib|incorrect header"):
            broken.collect()


def test_a_folder_that_is_no_partition_is_an_error(spark, tmp_path, many):
    path = tmp_path / "lake"
    write_lake(window_payloads(windows_of(spark)), str(path))
    (path / "year=2026/month=07/day=27/other=1").mkdir()
    with pytest.raises(ValueError, match="is not a folder of device_id"):
        read_lake(spark, str(path))


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
@pytest.mark.parametrize("zipped", [gzip.compress, bz2.compress, bytes])
def test_pieces_of_a_file_are_the_file(monkeypatch, size, zipped):
    """Every line is in one piece, however files are cut, and a file that ends early is an error."""
    monkeypatch.setattr(lake_files, "PIECE", size)
    name = {gzip.compress: "x.gz", bz2.compress: "x.bz2", bytes: "x.json"}[zipped]
    lines = [f"{i}:" + "abcé"[: i % 5] * (i % 9) for i in range(60)]
    for end in ("\n", ""):
        body = zipped(("\n".join(lines) + end).encode())
        found = [x for k in range(-(-len(body) // size)) for x in lake_files._lines(io.BytesIO(body), name, k)]
        assert found == lines
        if zipped is not bytes:
            with pytest.raises(EOFError):
                [lake_files._lines(io.BytesIO(body[:-4]), name, k) for k in range(-(-len(body) // size))]


def test_publishing_again_where_folders_are_many(spark, tmp_path, many):
    """A retry adds nothing, a changed batch takes the place of the old one, and files of a folder are put together."""
    windows, path = windows_of(spark), str(tmp_path / "lake")
    first = rows_of(publish(windows, path), *COLUMNS)
    publish(windows.where("window_id % 3 = 0"), path)
    assert rows_of(publish(windows, path), *COLUMNS) == first
    changed = windows.withColumn("rms", F.when(F.col("window_id") == 2, F.lit(-1.0)).otherwise(F.col("rms")))
    lake = publish(changed, path)
    assert lake.count() == len(first) and lake.where("features.rms = -1").count() == len(NAMES)
    write_lake(window_payloads(windows.withColumn("window_id", F.col("window_id") + 100)), path)
    before = rows_of(read_lake(spark, path), *COLUMNS)
    compact_lake(spark, path)
    assert rows_of(read_lake(spark, path), *COLUMNS) == before and list_lake(spark, path).where("n_files > 1").count() == 0


def test_a_synced_lake_of_many_folders(spark, tmp_path, many):
    windows, lake = windows_of(spark, names=["a", "b/c"]), str(tmp_path / "lake")
    archive_batches(windows, str(tmp_path / "a"))
    sinks.sync_to_lake(sinks.stream_archive(spark, str(tmp_path / "a")), lake, str(tmp_path / "c")).awaitTermination()
    assert "FileIndex" not in read_lake(spark, lake)._jdf.queryExecution().executedPlan().toString()
    names = ["device_id", "batch_id", "to_json(features)"]
    assert rows_of(read_lake(spark, lake), *names) == rows_of(window_payloads(windows), *names)


def test_batches_delivered_again_to_a_lake_of_many_folders(spark, tmp_path, many):
    windows, lake = windows_of(spark, names=["a", "b/c"]), str(tmp_path / "lake")
    for part in ("true", "window_id % 2 = 0"):
        archive_batches(windows.where(part), str(tmp_path / "a"))
        sinks.sync_to_lake(sinks.stream_archive(spark, str(tmp_path / "a")), lake, str(tmp_path / "c")).awaitTermination()
    found = publish(windows.where("window_id < 2"), lake)
    assert "FileIndex" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows_of(found, "device_id", "batch_id") == rows_of(window_payloads(windows), "device_id", "batch_id")


def test_the_backlog_neither_lists_nor_broadcasts_a_lake_of_many_folders(spark, tmp_path, many):
    windows, path = windows_of(spark, names=["a", "b/c", None]), str(tmp_path / "lake")
    archive_batches(windows, str(tmp_path / "a"))
    lake = publish(windows.where("window_id < 4"), path)
    # Its size is not known from the few days that the driver holds.
    assert lake._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > 1 << 40
    waiting, _ = backlog(spark, str(tmp_path / "a"), lake)
    assert "FileIndex" not in lake._jdf.queryExecution().executedPlan().toString()
    expected = [(d, k + 1) for d in ("a", "b/c", None) for k in range(windows.where("window_id >= 4").count() // 3)]
    assert rows_of(waiting, "device_id", "queue_position") == sorted(expected, key=repr)

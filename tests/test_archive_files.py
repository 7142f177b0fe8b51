"""The archive source: every finished file, in bounded pieces, with what is wrong with it."""

import gzip
import io
import json
import zlib

import pytest

from tests.helpers import rows_of
from tremorline.sources import archive_files
from tremorline.sources.archive import audit_archive, audit_archive_folder, fill_missing_time, split_quarantine, with_device
from tremorline.sources.archive_files import fault_of, lines_of, read_lines, store_of

RECORD = json.dumps({"timestamp": 1785110400.0, "device_id": "d", "features": {"rms": 1.5}, "anomaly_detected": True})


def put(folder, name, body):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(body)


BODIES = [
    (b"\x00 neither zipped nor JSON", "not gzip"),
    (gzip.compress(b"x" * 5000)[:-9], "not gzip"),
    (gzip.compress(RECORD.encode())[:-1] + b"!", "not gzip"),
    (gzip.compress(b"a\n") + b"junk", "not gzip"),
    (gzip.compress(b"ok\n\xff\xfe"), "not utf-8"),
    (gzip.compress("é".encode()[:1]), "not utf-8"),
    (gzip.compress(b"\xff" * 100)[:-9], "not gzip"),
    (gzip.compress(b""), "empty"),
    (gzip.compress(b" \n\t\n"), "empty"),
    (gzip.compress(b"one") + gzip.compress(b" more\ntwo"), None),
    (gzip.compress(b"padded") + b"\x00" * 8, None),
]


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
@pytest.mark.parametrize("body, reason", BODIES)
def test_faults(monkeypatch, piece, body, reason):
    monkeypatch.setattr(archive_files, "PIECE", piece)
    assert fault_of(io.BytesIO(body)) == reason


@pytest.mark.parametrize("piece", [1, 5, 64, 1 << 20])
def test_lines_across_pieces(monkeypatch, piece):
    monkeypatch.setattr(archive_files, "PIECE", piece)
    monkeypatch.setattr(archive_files, "LINES_PER_BATCH", 3)
    text = "one\r\n\n  two é 𝄞 \nthree still three\n\nfour\nfive"
    found = list(lines_of(io.BytesIO(gzip.compress(text.encode()))))
    assert [line for part in found for line in part] == ["one", "two é 𝄞", "three still three", "four", "five"]
    assert [len(part) for part in found] == [3, 2]


def test_a_crafted_file_is_not_unpacked_whole():
    """A gigabyte of zeros in a megabyte, and one line without an end, end with a reason after a bounded number of bytes."""
    packer = zlib.compressobj(9, wbits=31)
    bomb = b"".join(packer.compress(bytes(1 << 20)) for _ in range(64)) + packer.flush()
    assert fault_of(io.BytesIO(bomb), max_file=8 << 20) == "too large"
    assert fault_of(io.BytesIO(bomb), max_line=8 << 20) == "line too long"
    assert fault_of(io.BytesIO(gzip.compress(b"abcdefgh\nab")), max_line=7) == "line too long"
    assert fault_of(io.BytesIO(gzip.compress(b"abcdefg\nabcdefg")), max_line=7) is None
    assert list(read_lines(lambda: io.BytesIO(b""))) == [([None], "empty")]


def test_the_layout_of_an_archive(spark, tmp_path, monkeypatch):
    folder = tmp_path / "queue"
    put(folder, "batch_1.json.gz", gzip.compress(f"{RECORD}\n{RECORD}\n".encode()))
    put(folder, "batch_2.json.gz", b"")
    put(folder, "batch_3.json.gz.tmp", gzip.compress(RECORD.encode()))
    put(folder, "batch_4.json.gz", gzip.compress(RECORD.encode())[:-9])
    put(folder, "batch_5.json.gz", gzip.compress(b'{"features": {"rms": 1.0}}'))
    put(folder, "batch_6.json.gz", gzip.compress(b"\n"))
    put(folder, "other.json.gz", gzip.compress(RECORD.encode()))
    put(folder / "quarantine", "batch_7.json.gz", b"NO")
    for path in (str(folder), f"file:{folder}", f"file://{folder}"):
        audited = audit_archive_folder(spark, path)
        good, bad = split_quarantine(audited)
        assert rows_of(good, "device_id", "batch_id", "features.rms") == [("d", "batch_1.json.gz", 1.5)] * 2
        assert dict(rows_of(bad, "file_name", "reason")) == {
            "batch_2.json.gz": "zero bytes", "batch_4.json.gz": "not gzip", "batch_5.json.gz": "no timestamp", "batch_6.json.gz": "empty"
        }
    # But for files of zero bytes it agrees with Spark's own listing.
    names = ("file_name", "record", "reason", "timestamp", "device_id")
    assert rows_of(audited.where("reason IS NULL OR reason <> 'zero bytes'"), *names) == rows_of(audit_archive(spark, str(folder), "batch_*.json.gz"), *names)
    dated = with_device(fill_missing_time(audited), "edge").where("file_name = 'batch_5.json.gz'").first()
    assert dated.device_id == "edge" and dated.reason is None
    assert dated.timestamp == pytest.approx((folder / "batch_5.json.gz").stat().st_mtime, abs=1e-3)
    assert audit_archive_folder(spark, str(tmp_path / "nowhere")).count() == 0


def test_files_are_dealt_by_size(tmp_path, monkeypatch):
    monkeypatch.setattr(archive_files, "TASK_BYTES", 1 << 18)
    for i in range(40):
        put(tmp_path / "q", f"batch_{i:02d}.json.gz", b"x" * (i * 1000))
    runs = archive_files._Reader(str(tmp_path / "q"), "batch_*").partitions()
    assert [name for run in runs for name, *_ in run.files] == [f"{tmp_path}/q/batch_{i:02d}.json.gz" for i in range(40)]
    assert len(runs) == 10
    assert store_of("file:///a/b")[1] == store_of("file:/a/b")[1] == store_of("/a/b")[1] == "/a/b"

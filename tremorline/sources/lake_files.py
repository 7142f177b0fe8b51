"""The lake's files in a local or mounted folder, where Spark's writer starts processes (chmod) for every file and folder.

A lake has a folder for each device and day, so that most files hold a few rows and these processes are nearly all of the time. Here a task
writes its files itself, under names that follow from the write and the task: a task that is tried again puts the same files in the
place of those it had written. A file has another name, which readers pass over, until it is whole.

A lake of many folders is listed and read in the same manner, as the driver would hold an entry for every file of it, whatever is asked
for: the driver only looks at days and counts, a task lists a part of a day's devices, and reads their files line by line. What is kept
of a file and of a folder follows Spark's readers, so both ways give the same rows.
"""

from __future__ import annotations

import bz2
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorline.model import LAKE_SCHEMA, PARTITION_COLUMNS
from tremorline.sources.archive_files import store_of

#: How Spark names the folders of a partitioned table.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = {c: f"%{c:02X}" for c in [*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^")]}


def is_local(path: str) -> bool:
    """Whether a path is absolute and has no scheme or that of a local file system."""
    return path.startswith(("/", "file:/"))


def folder_name(values: tuple[str | None, ...]) -> str:
    """``year=YYYY/month=MM/day=DD/device_id=ID``; an empty text is like a missing one, as Spark has it."""
    return "/".join(f"{c}={v.translate(ESCAPED) if v else NO_VALUE}" for c, v in zip(PARTITION_COLUMNS, values, strict=True))


def _put(path: str, write: str, max_records: int):
    """Writes rows that are in order of folders, and gives back the number of files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, root = store_of(path)
        name = f"part-{TaskContext.get().partitionId():05d}-{write}"
        n_files, current, out, written = 0, None, None, 0
        hidden = whole = ""

        def close() -> None:
            out.close()
            os.replace(hidden, whole)

        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in PARTITION_COLUMNS), strict=True)
            for place, record in zip(places, batch.column("record").to_pylist(), strict=True):
                if out is None or place != current or written >= max_records:
                    if out is not None:
                        close()
                    folder = f"{root}/{folder_name(place)}"
                    if place != current:
                        _make(folder)
                    file = f"{name}-c{n_files:06d}.json.gz"
                    hidden, whole = f"{folder}/.{file}", f"{folder}/{file}"
                    out = _Zipped(hidden)
                    n_files, current, written = n_files + 1, place, 0
                out.write(f"{record}\n".encode())
                written += 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n_files], pa.int64())], names=["n_files"])

    return run


def _make(folder: str) -> None:
    """Make a folder; nearly always only its last part is missing."""
    try:
        os.mkdir(folder)
    except FileExistsError:
        pass
    except FileNotFoundError:
        os.makedirs(folder, exist_ok=True)


class _Zipped:
    def __init__(self, path: str):
        self.stream = open(path, "wb")
        self.body = zlib.compressobj(6, zlib.DEFLATED, zlib.MAX_WBITS | 16)

    def write(self, data: bytes) -> None:
        self.stream.write(self.body.compress(data))

    def close(self) -> None:
        self.stream.write(self.body.flush())
        self.stream.close()


def append_files(rows: DataFrame, path: str, max_records: int) -> int:
    """Write each partition of ``rows``, whose folders are not dealt over more than they need, as files; returns their number."""
    fields = [c for c in rows.columns if c not in PARTITION_COLUMNS]
    records = rows.select(*PARTITION_COLUMNS, F.to_json(F.struct(*fields)).alias("record"))
    # All columns are in the order, so that a task tried again writes the same files.
    ordered = records.sortWithinPartitions(*PARTITION_COLUMNS, "record")
    put = _put(path, uuid.uuid4().hex, max_records)
    return ordered.mapInArrow(put, "n_files bigint").agg(F.sum("n_files")).first()[0] or 0


#: A lake of more folders is listed and read by tasks, each taking about so many folders.
FEW_FOLDERS = 256
FOLDERS_PER_TASK = 1000
#: Larger files are read in pieces of so many bytes as they lie there, zipped; lines are handed over when there are about so many bytes of them.
PIECE = 4 << 20

FILES = "array<struct<device_id: string, file: string, length: bigint>>"
LINES = pa.struct([("record", pa.string()), ("file_size", pa.int64())])


def _shown(name: str) -> bool:
    """Whether Spark's readers see a file or folder of that name."""
    if name.startswith("_"):
        return "=" in name or name.startswith(("_common_metadata", "_metadata"))
    return not name.startswith(".") and not name.endswith("._COPYING_")


def _value(name: str) -> str | None:
    """The value of a folder ``column=value``."""
    text = name.partition("=")[2]
    return None if text == NO_VALUE else re.sub("%([0-9A-Fa-f]{2})", lambda found: chr(int(found[1], 16)), text)


def _folders(folder: str, column: str) -> Iterator[str]:
    """The folders ``column=value`` in a folder, one at a time."""
    with os.scandir(folder) as entries:
        for entry in entries:
            if _shown(entry.name) and entry.is_dir():
                if not entry.name.startswith(f"{column}="):
                    raise ValueError(f"{entry.path} is not a folder of {column}")
                yield entry.name


def _slices(path: str) -> tuple[list[tuple], int]:
    """(year, month, day, folder, slice, slices) of each day, and the number of devices' folders, which are counted and not held."""
    days, total, found = [((), store_of(path)[1].rstrip("/"))], 0, []
    for column in PARTITION_COLUMNS[:-1]:
        days = [((*values, _value(name)), f"{folder}/{name}") for values, folder in days for name in _folders(folder, column)]
    for values, folder in days:
        n = sum(1 for _ in _folders(folder, PARTITION_COLUMNS[-1]))
        slices, total = max(1, -(-n // FOLDERS_PER_TASK)), total + n
        found += [(*values, folder, k, slices) for k in range(slices)]
    return found, total


def has_many_folders(path: str) -> bool:
    """Whether a lake is local and has more than ``FEW_FOLDERS`` folders of devices; no more are counted."""
    return is_local(path) and next(islice(_devices(store_of(path)[1].rstrip("/"), PARTITION_COLUMNS), FEW_FOLDERS, None), None) is not None


def _devices(folder: str, columns: list[str]) -> Iterator[str]:
    if not columns:
        yield folder
    elif os.path.isdir(folder):
        with os.scandir(folder) as entries:
            for entry in entries:
                if entry.name.startswith(f"{columns[0]}="):
                    yield from _devices(entry.path, columns[1:])


def _list(folders: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The files of a slice of a day, but for empty ones."""
    kind = pa.list_(pa.struct([("device_id", pa.string()), ("file", pa.string()), ("length", pa.int64())]))
    for columns in folders:
        for day, number, slices in zip(*(c.to_pylist() for c in columns), strict=True):
            files = []
            for name in _folders(day, PARTITION_COLUMNS[-1]):
                if zlib.crc32(os.fsencode(name)) % slices == number:
                    device = _value(name)
                    with os.scandir(f"{day}/{name}") as entries:
                        for entry in entries:
                            if _shown(entry.name) and entry.is_file() and (length := entry.stat().st_size):
                                files.append({"device_id": device, "file": entry.path, "length": length})
            yield pa.array([files], kind)


def _unzipped(stream: BinaryIO, name: str) -> Iterator[bytes]:
    """What each piece of a file unpacks to; fails on a file that ends early, as Spark's readers do."""
    suffix = name.rpartition(".")[2]
    if suffix in ("zst", "lz4", "snappy", "lzo"):
        raise ValueError(f"{name}: only gzip, bzip2, deflate and plain text are read in a lake of many folders")
    new = {"gz": lambda: zlib.decompressobj(zlib.MAX_WBITS | 16), "deflate": zlib.decompressobj, "bz2": bz2.BZ2Decompressor}.get(suffix)
    unpack = None
    while piece := stream.read(PIECE):
        text = [] if new else [piece]
        while new and piece:
            # A file may be several zipped ones in a row.
            unpack = unpack or new()
            text.append(unpack.decompress(piece))
            piece, unpack = (unpack.unused_data, None) if unpack.eof else (b"", unpack)
        yield b"".join(text)
    if unpack is not None:
        raise EOFError(f"{name} ends early")


def _lines(stream: BinaryIO, name: str, piece: int) -> list[str]:
    """The lines that begin in a piece of a file."""
    body, begins = [], True
    for number, text in enumerate(_unzipped(stream, name)):
        if number < piece:
            begins = text.endswith(b"\n") if text else begins
            continue
        if number == piece and not begins:
            cut = text.find(b"\n") + 1
            text = text[cut:] if cut else b""
        elif number > piece:
            if not body or body[-1].endswith(b"\n"):
                break
            text = text[: text.find(b"\n") + 1] or text
        body += [text] if text else []
    return [line.decode(errors="replace") for line in b"".join(body).splitlines() if line.strip()]


def _read(files: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The lines of a piece of a file, and the size that its reader is told."""
    for columns in files:
        ends, lines, sizes, n_bytes = [0], [], [], 0
        for file, piece in zip(*(c.to_pylist() for c in columns), strict=True):
            with open(file, "rb") as stream:
                found, size = _lines(stream, file, piece), os.fstat(stream.fileno()).st_size
            lines += found
            sizes += [size] * len(found)
            ends.append(len(lines))
            n_bytes += sum(map(len, found))
            if n_bytes >= PIECE:
                yield _lists(ends, lines, sizes)
                ends, lines, sizes, n_bytes = [0], [], [], 0
        if len(ends) > 1:
            yield _lists(ends, lines, sizes)


def _lists(ends: list[int], lines: list[str], sizes: list[int]) -> pa.Array:
    values = pa.StructArray.from_arrays([pa.array(lines, pa.string()), pa.array(sizes, pa.int64())], fields=list(LINES))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(year, month, day, device_id, file, length) of a local lake, listed by tasks when it is asked for.

    Days and slices of them are rows of a small table, and all that follows is made of them by expressions, so that the
    optimizer brings a filter on days to this table, and one on devices before files are opened.
    """
    slices, n_folders = _slices(path)
    names = [*PARTITION_COLUMNS[:-1], "_day", "_slice", "_slices"]
    # Made of rows, not of an Arrow table: its size is unknown to the optimizer, which would take that of an Arrow table for that of the
    # lake, and send the lake to all tasks by the driver.
    table = spark.createDataFrame(slices, ", ".join([f"{n} string" for n in names[:4]] + [f"{n} int" for n in names[4:]]))
    n_tasks = max(1, -(-n_folders // FOLDERS_PER_TASK), min(len(slices), 2 * spark.sparkContext.defaultParallelism))
    dealt = table.repartition(n_tasks, "_day", "_slice")
    listed = F.arrow_udf(_list, FILES)("_day", "_slice", "_slices")
    return dealt.select(*PARTITION_COLUMNS[:-1], F.inline(listed))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The records of a local lake, with the name and size of the file of each, as Spark's reader gives them."""
    pieces = F.sequence(F.lit(0), F.floor((F.col("length") - 1) / PIECE).cast("int"))
    files = list_files(spark, path).select(*PARTITION_COLUMNS, "file", F.explode(pieces).alias("_piece"))
    read = F.arrow_udf(_read, "array<struct<record: string, file_size: bigint>>")("file", "_piece")
    lines = files.select(*PARTITION_COLUMNS, "file", F.inline(read))
    body = T.StructType([f for f in LAKE_SCHEMA.fields if f.name not in PARTITION_COLUMNS])
    parsed = lines.withColumn("_parsed", F.from_json("record", body))
    fields = [F.col("_parsed")[f.name].alias(f.name) for f in body.fields]
    return parsed.select(*fields, *PARTITION_COLUMNS, F.col("file").alias("file_path"), "file_size")

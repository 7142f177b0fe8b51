"""An archive folder as a data source that lists the files itself and unpacks them in bounded pieces.

Spark's file sources pass over zero-byte files and hold a file's body as one value. This source sees every finished file, says what is
wrong with it, and reads it twice: once to the end to learn whether it is whole, once to give its lines. Neither holds
more than a piece of the text and one line. Files are dealt to tasks by size.
"""

from __future__ import annotations

import codecs
import fnmatch
import gzip
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PIECE = 1 << 20
#: A line, and an unpacked file, may not be longer than this; what is longer is set aside with a reason.
MAX_LINE = 64 << 20
MAX_FILE = 16 << 30
LINES_PER_BATCH = 10_000
TASK_BYTES = 64 << 20
#: Fixed value: files still being written end so.
IN_PROGRESS = ".tmp"

SCHEMA = "file_name string, ingested double, record string, _reason string"


def _unpacked(stream: BinaryIO) -> Iterator[bytes]:
    with gzip.GzipFile(fileobj=stream) as body:
        while piece := body.read(PIECE):
            yield piece


def fault_of(stream: BinaryIO, max_file: int = MAX_FILE, max_line: int = MAX_LINE) -> str | None:
    """Why a file cannot be read as lines of text, or None. A damaged end condemns all of it."""
    decoder, broken, size, line, blank = codecs.getincrementaldecoder("utf-8")(), None, 0, 0, True
    try:
        for piece in _unpacked(stream):
            size += len(piece)
            if size > max_file:
                return "too large"
            cut = piece.rfind(b"\n")
            longest = max((len(part) for part in piece.split(b"\n")), default=0)
            if max(line + piece.find(b"\n") if cut >= 0 else line + len(piece), longest) > max_line:
                return "line too long"
            line = len(piece) - cut - 1 if cut >= 0 else line + len(piece)
            blank = blank and not piece.strip()
            if broken is None:
                try:
                    decoder.decode(piece)
                except UnicodeDecodeError:
                    broken = "not utf-8"
    except (OSError, EOFError, zlib.error):
        return "not gzip"
    if broken is None:
        try:
            decoder.decode(b"", final=True)
        except UnicodeDecodeError:
            broken = "not utf-8"
    return broken or ("empty" if blank else None)


def lines_of(stream: BinaryIO) -> Iterator[list[str]]:
    """The non-blank lines of a file that has no fault, so many at a time."""
    decoder, held, rest = codecs.getincrementaldecoder("utf-8")(), [], ""
    for piece in _unpacked(stream):
        *whole, rest = (rest + decoder.decode(piece)).split("\n")
        held += [text for text in map(str.strip, whole) if text]
        while len(held) >= LINES_PER_BATCH:
            yield held[:LINES_PER_BATCH]
            held = held[LINES_PER_BATCH:]
    held += [rest.strip()] if rest.strip() else []
    if held:
        yield held


def read_lines(open_file: Callable[[], BinaryIO]) -> Iterator[tuple[list[str | None], str | None]]:
    """(lines, no reason) in pieces, or one missing line and the reason why there is none."""
    with open_file() as stream:
        reason = fault_of(stream)
    if reason:
        yield [None], reason
        return
    with open_file() as stream:
        for lines in lines_of(stream):
            yield lines, None


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, with or without a scheme, and the path in it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon and scheme == "file" else path).lstrip("/")
    return fs.FileSystem.from_uri(path)


class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, int, float]]):
        super().__init__(files)
        self.files = files


class _Reader(DataSourceReader):
    def __init__(self, path: str, pattern: str):
        self.path, self.pattern = path, pattern

    def partitions(self) -> list[_Files]:
        """The finished files of the folder, not of folders in it, in runs of a bounded size."""
        store, folder = store_of(self.path)
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        wanted = [f for f in found if f.is_file and not f.base_name.endswith(IN_PROGRESS) and fnmatch.fnmatchcase(f.base_name, self.pattern)]
        runs, size = [], TASK_BYTES
        for file in sorted(wanted, key=lambda f: f.base_name):
            if size >= TASK_BYTES:
                runs.append([])
                size = 0
            runs[-1].append((file.path, file.size, file.mtime.timestamp() if file.mtime else 0.0))
            size += max(file.size, 1 << 16)
        return [_Files(run) for run in runs]

    def read(self, partition: _Files | None) -> Iterator[pa.RecordBatch]:
        # A folder without files is read as one partition that is none.
        if partition is None:
            return
        store, _ = store_of(self.path)
        for path, size, ingested in partition.files:
            pieces = read_lines(lambda path=path: store.open_input_stream(path, compression=None)) if size else [([None], "zero bytes")]
            for lines, reason in pieces:
                n = len(lines)
                columns = [pa.array([path.rsplit("/", 1)[-1]] * n), pa.array([ingested] * n, pa.float64()), pa.array(lines, pa.string()),
                           pa.array([reason] * n, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["file_name", "ingested", "record", "_reason"])


class ArchiveFolder(DataSource):
    """``spark.read.format("batch_archive").option("pattern", ...).load(path)``: one row per line, or per file without lines."""

    @classmethod
    def name(cls) -> str:
        return "batch_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("pattern", "batch_*.json.gz"))

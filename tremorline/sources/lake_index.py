"""What a lake holds, so that a write need not look at its folders.

``_index`` in the lake's folder, which Spark's readers pass over, has the key and a hash of the content of every batch. Each write
adds a table of its own keys, sorted, so that Parquet's ranges and Bloom filters answer most questions without reading a row; ``FAN``
tables of a level are put together into one of the next, so every key is rewritten a logarithmic number of times.

A write first states what it is about to add, in ``pending``, and makes that a table of the index when the batches are there. What a
writer that died has left pending is looked up in the folders it names, and what arrived is indexed, before the next write.
One writer at a time: a file made by one atomic step is the lock. A writer finds its own lock, under its name, after a restart.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from tremorline.model import PARTITION_COLUMNS, PAYLOAD_SCHEMA

FAN = 16
#: So many keys are asked for by value, which reaches the Parquet scan; more are joined.
KEYS_IN_FILTER = 1000
ENTRY = "key string, content bigint, version bigint"
LAKE_KEY = [*PARTITION_COLUMNS, "batch_id"]


class LakeBusy(RuntimeError):
    """Another writer holds the lake."""


def batch_key() -> Column:
    """Day, device and batch as one text that sorts by day; a missing part equals itself."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in LAKE_KEY]
    return F.concat_ws("/", F.concat(*parts[:3]), *[F.replace(p, F.lit("/"), F.lit("//")) for p in parts[3:]])


def content_hash() -> Column:
    return F.xxhash64(*[f.name for f in PAYLOAD_SCHEMA.fields])


class Folder:
    """A folder of a file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name))) if self.exists(name) else []

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self._at(old), self._at(new)):
            raise OSError(f"could not rename {self.path}/{old}")

    def make(self, name: str) -> None:
        self._fs.mkdirs(self._at(name))

    def create(self, name: str, text: str) -> bool:
        """Make a file; false if it is there."""
        try:
            out = self._fs.create(self._at(name), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName() or "already exists" in str(error.java_exception):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def text(self, name: str) -> str | None:
        try:
            stream = self._fs.open(self._at(name))
        except Py4JJavaError:
            return None
        found = bytes(stream.readNBytes(4096)).decode()
        stream.close()
        return found


class LakeIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.folder = Folder(spark, f"{self.path}/_index")

    # The lock

    @contextmanager
    def held(self, owner: str | None, wait: float) -> Iterator[None]:
        """Hold the lake's lock; ``owner`` finds its own again after it died, others wait so many seconds and give up."""
        owner = owner or uuid.uuid4().hex
        self.folder.make("keys")
        until = time.monotonic() + wait
        while not self.folder.create("lock", owner):
            holder = self.folder.text("lock")
            if holder == owner:
                break
            if time.monotonic() >= until:
                raise LakeBusy(f"{self.path} is written by {holder!r}; if that writer is gone, call release_lake")
            time.sleep(0.2)
        try:
            yield
        finally:
            self.folder.delete("lock")

    # Tables of keys

    def _tables(self) -> list[tuple[int, int, str]]:
        found = [n for n in self.folder.names("keys") if n.startswith("level=")]
        return [(int(n[6:8]), int(n.rsplit("-", 1)[1]), n) for n in found]

    def _next(self) -> int:
        pending = [int(n) for n in self.folder.names("pending") if n.isdigit()]
        return max([version for _, version, _ in self._tables()] + pending, default=0) + 1

    def _write(self, entries: DataFrame, name: str) -> None:
        ranged = entries.repartitionByRange("key").sortWithinPartitions("key")
        ranged.write.mode("overwrite").option("parquet.bloom.filter.enabled#key", "true").parquet(f"{self.folder.path}/{name}")

    def entries(self) -> DataFrame:
        """The latest content of every key."""
        paths = [f"{self.folder.path}/keys/{n}" for *_, n in self._tables()]
        return self._read(paths)

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(*paths) if paths else self.spark.createDataFrame([], ENTRY)

    def known(self, fresh: DataFrame, n_fresh: int) -> DataFrame:
        """(key, known): the content on record for keys of ``fresh``."""
        entries = self.entries()
        if n_fresh <= KEYS_IN_FILTER:
            entries = entries.where(F.col("key").isin([r["key"] for r in fresh.select("key").distinct().collect()]))
        else:
            ends = fresh.agg(F.min("key"), F.max("key")).first()
            entries = entries.where(F.col("key").between(*ends)).join(fresh.select("key").distinct(), "key", "left_semi")
        return entries.groupBy("key").agg(F.max_by("content", "version").alias("known"))

    def state(self, added: DataFrame) -> int:
        """Say what is about to be written: keys, contents and folders."""
        version = self._next()
        rows = added.select("key", "content", F.lit(version).cast("bigint").alias("version"), *PARTITION_COLUMNS)
        self._write(rows, f"pending/{version}")
        return version

    def confirm(self, version: int) -> None:
        """What was stated is written."""
        self.folder.rename(f"pending/{version}", f"keys/level=00-{version:012d}")
        self._put_together()

    def _put_together(self) -> None:
        level = 0
        while True:
            same = [(version, name) for found, version, name in self._tables() if found == level]
            if len(same) < FAN:
                return
            merged = self._read([f"{self.folder.path}/keys/{name}" for _, name in same])
            newest = merged.groupBy("key").agg(F.max(F.struct("version", "content")).alias("m"))
            self._write(newest.select("key", "m.content", "m.version"), "merging")
            # A reader or a crash in between meets keys twice, with one version.
            self.folder.rename("merging", f"keys/level={level + 1:02d}-{max(same)[0]:012d}")
            for _, name in same:
                self.folder.delete(f"keys/{name}")
            level += 1

    def recover(self, read: Callable[[], DataFrame | None]) -> None:
        """Index what writers that died have left in the lake, and what was there before there was an index.

        Only then is the lake asked for: its folders are listed as soon as it is read.
        """
        indexed, left = self._tables(), self.folder.names("pending")
        if indexed and not left:
            return
        lake = read()
        if lake is not None and not indexed and not left:
            found = lake.select(batch_key().alias("key"), content_hash().alias("content"), F.lit(0).cast("bigint").alias("version"))
            self._write(found, "merging")
            self.folder.rename("merging", f"keys/level=99-{0:012d}")
        for name in left:
            path = f"{self.folder.path}/pending/{name}"
            stated = self._stated(path)
            if lake is not None and stated is not None:
                folders = stated.select(*PARTITION_COLUMNS).distinct()
                same = [lake[c].eqNullSafe(folders[c]) for c in PARTITION_COLUMNS]
                there = lake.join(folders, same[0] & same[1] & same[2] & same[3], "left_semi")
                there = there.select(batch_key().alias("key"), content_hash().alias("content"))
                arrived = stated.select("key", "content", "version").join(there, ["key", "content"], "left_semi")
                self._write(arrived, "merging")
                self.folder.rename("merging", f"keys/level=00-{int(name):012d}")
            self.folder.delete(f"pending/{name}")

    def _stated(self, path: str) -> DataFrame | None:
        """A pending statement, unless its writer died while writing it; then nothing followed."""
        if "_SUCCESS" not in Folder(self.spark, path).names():
            return None
        schema = ENTRY + ", " + ", ".join(f"{c} string" for c in PARTITION_COLUMNS)
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException:
            return None

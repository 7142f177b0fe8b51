"""Exact duplicates through an extendible-hash index on shared files.

1. Every document becomes a slip: key (the first 63 bits of the digest of its text without white space),
   digest, length. A mapper hands over a text's bytes only where it meets them first; further copies of its own
   are recognised in a chain per key, by comparing bytes. So a group of copies, however large, leaves a mapper
   a few times at most.
2. The directory starts with one bucket and doubles, one more bit of the key each time, until no bucket holds
   more bytes than its limit; only overfull buckets are split. The limit grows with the table so that the
   directory stays below a fixed number of buckets; it is therefore small enough to be sent to every task.
3. The texts handed over go to the owner of their bucket, a range of keys. Owners walk their keys in order,
   chain texts that collide, compare bytes, and write the index: key, slot in the chain, digest.
4. Slips are counted per digest before the shuffle, joined with the index, and summed per (key, slot).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import BLANKS, keep_rows, stored, text_of, unused

KEY_BITS = 63
BUCKET_BYTES = 16 << 20
MAX_BUCKETS = 1 << 18
#: A mapper forgets the texts it has seen when they come to so many bytes.
SEEN_BYTES = 48 << 20

SLIPS = "row_id bigint, doc_id bigint, text_hash bigint, key bigint, digest binary, points bigint, n_bytes bigint, body binary"
INDEX = "bucket bigint, key bigint, slot bigint, digest binary"


def _slips(key_bits: int, seen_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, seen, held = TaskContext.get().partitionId() << 40, {}, 0
        for batch in batches:
            points = pc.utf8_length(batch.column("text"))
            keys, digests, sizes, bodies = [], [], [], []
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                body = raw.translate(None, BLANKS)
                digest = hashlib.sha256(body).digest()
                key = (int.from_bytes(digest[:8], "big") >> 1) >> (KEY_BITS - key_bits) << (KEY_BITS - key_bits)
                chain = seen.setdefault(key, [])
                known = any(body == other for other in chain)
                if not known:
                    chain.append(body)
                    held += len(body) + 200
                keys.append(key)
                digests.append(digest)
                sizes.append(len(body))
                bodies.append(None if known else body)
                if held > seen_bytes:
                    seen, held = {}, 0
            rows = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.int64()), pa.array(digests, pa.binary()),
                 points.cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(bodies, pa.binary())],
                names=["row_id", "doc_id", "text_hash", "key", "digest", "points", "n_bytes", "body"],
            )

    return run


def grow_directory(entries: DataFrame, limit: int, max_buckets: int = MAX_BUCKETS) -> np.ndarray:
    """The first key of every bucket, ascending, for rows (key, n_bytes).

    Counts per prefix are made by Spark; what arrives here are at most a few times ``max_buckets`` sums, since
    only buckets above the limit are looked at again, with four more bits.
    """
    total = entries.agg(F.sum("n_bytes")).first()[0] or 0
    limit = max(limit, 4 * total // max_buckets, 1)
    starts, overfull, depth = [0], [0] if total > limit else [], 0
    while overfull:
        bits = min(KEY_BITS - depth, max(4, int(total // limit).bit_length() + 1 if depth == 0 else 4))
        shift = KEY_BITS - depth - bits
        rows = entries
        if depth:
            parents = entries.sparkSession.createDataFrame([(p,) for p in overfull], "parent bigint")
            rows = rows.join(F.broadcast(parents), F.shiftright("key", shift + bits) == F.col("parent"), "left_semi")
        cells = (
            rows.groupBy(F.shiftright("key", shift).alias("cell"))
            .agg(F.sum("n_bytes").alias("load"), (F.min("key") < F.max("key")).alias("several"))
            .orderBy("cell")
            .toPandas()
        )
        cell, load = cells["cell"].to_numpy(np.int64), cells["load"].to_numpy(np.int64)
        several = dict(zip(cell.tolist(), cells["several"], strict=True))
        before = np.concatenate([[0], np.cumsum(load)])
        for step in range(1, bits + 1):  # the directory doubles; overfull buckets part at the new bit
            nodes = []
            for parent in overfull:
                for child in (2 * parent, 2 * parent + 1):
                    lo, hi = np.searchsorted(cell, [child << (bits - step), (child + 1) << (bits - step)])
                    if child & 1:
                        starts.append(child << (KEY_BITS - depth - step))
                    if before[hi] - before[lo] > limit:
                        nodes.append(child)
            overfull = nodes
        depth += bits
        overfull = [p for p in overfull if several.get(p)] if depth < KEY_BITS else []
    return np.array(sorted(starts), dtype=np.int64)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk the keys in order; texts of one key that differ get slots of their own."""
    current, chain = None, []
    for batch in batches:
        out = []
        bodies = batch.column("body").to_pylist()
        for i, (bucket, key, digest) in enumerate(
            zip(*(batch.column(c).to_pylist() for c in ("bucket", "key", "digest")), strict=True)
        ):
            if key != current:
                current, chain = key, []
            if not any(bodies[i] == body for body in chain):
                out.append((bucket, key, len(chain), digest))
                chain.append(bodies[i])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True) if out else ([],) * 4,
                                                  (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
            names=["bucket", "key", "slot", "digest"],
        )


def exact_groups(
    docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, key_bits: int = KEY_BITS, seen_bytes: int = SEEN_BYTES
) -> DataFrame:
    """One row per document: which documents have the same text, and which one of them stays.

    Texts are equal when they agree after deleting all white space; a null text is an empty one, and all empty
    texts are one group. The row with the most code points in its original text stays, then the smallest
    doc_id (a missing one last); of rows equal in these too, one. Reads the columns doc_id and text, whatever else there is.
    An empty table gives no rows.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of(docs)).alias("text_hash"), text_of(docs).alias("text")
    )
    slips = stored(source.mapInArrow(_slips(key_bits, seen_bytes), SLIPS), "slips")
    handed = slips.where("body IS NOT NULL")
    starts = grow_directory(
        handed.groupBy("key", "digest").agg(F.max("n_bytes").alias("n_bytes")).select("key", "n_bytes"), bucket_bytes
    )

    def bucket_of(batches):
        for batch in batches:
            found = np.searchsorted(starts, batch.column("key").to_numpy(), side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int64)), *(batch.column(c) for c in ("key", "digest", "body"))],
                names=["bucket", "key", "digest", "body"],
            )

    placed = handed.select("key", "digest", "body").mapInArrow(
        bucket_of, "bucket bigint, key bigint, digest binary, body binary"
    )
    owned = placed.repartition("bucket").sortWithinPartitions("bucket", "key")
    index = stored(owned.mapInArrow(_own, INDEX), "index")

    slim = slips.drop("body")
    best = F.min(F.struct((-F.col("points")).alias("rank"), F.col("doc_id").isNull().alias("none"), "doc_id", "row_id", "text_hash"))
    counted = slim.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("n"), best.alias("best"))
    placed_counts = counted.join(index, ["key", "digest"])
    groups = placed_counts.groupBy("key", "slot").agg(F.sum("n").alias("group_size"), F.min("best").alias("best"))
    classes = placed_counts.select("key", "digest", "bucket", "slot").join(groups, ["key", "slot"])
    return slim.join(classes, ["key", "digest"]).select(
        "doc_id",
        "text_hash",
        F.col("best.doc_id").alias("keep_id"),
        F.col("best.text_hash").alias("keep_hash"),
        "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "bucket",
        "slot",
        "points",
        "n_bytes",
    )


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents without exact copies, columns unchanged; of rows that agree in id and text any one stays."""
    groups = stored(exact_groups(docs, **options), "exact")
    left = keep_rows(docs, groups.where("kept"))
    twins = groups.where("NOT kept AND doc_id <=> keep_id AND text_hash = keep_hash")
    if twins.isEmpty():
        return left
    key = unused("text_hash", docs)
    return left.withColumn(key, F.xxhash64(text_of(left))).dropDuplicates(["doc_id", key]).drop(key)


SQL = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS place,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM plain
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

"""Lines that recur across documents but for their variable fields, by a log-template tree.

A line's leaf in the tree is its token count and its leading ``DEPTH`` tokens; tokens with digits are variable. Only
leaves that ``MIN_DOCS`` documents reach can hold a recurring line. In those a token is constant if it stands at its
place in ``MIN_DOCS`` documents; the other places of a line are fields. A line's template is its leaf and its constant
tokens, and it counts if at least ``STABLE`` of its tokens are constant, so prose that shares an opening does not become a
template. Lines of templates that recur in ``MIN_DOCS`` documents are dropped, but for the first in the document with the
smallest id.

Everything counted is counted before the shuffle; no group of lines comes together in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import stored, text_of

DEPTH = 4
MIN_DOCS = 5
STABLE = 0.7
#: Leaves are sent to all tasks up to so many; beyond it lines are joined with them.
LEAVES_TO_SEND = 500_000

_DIGITS = b"0123456789"
FIELD = b"<*>"
LINES = "doc_id bigint, text_hash bigint, row bigint, line int, leaf bigint, places array<bigint>, fresh array<bigint>"


def parse(line: bytes) -> tuple[int, list[bytes]]:
    """The leaf of a line, and its tokens with variable ones marked."""
    tokens = line.split()
    if len(line.translate(None, _DIGITS)) != len(line):
        tokens = [FIELD if len(t.translate(None, _DIGITS)) != len(t) else t for t in tokens]
    head = b"%d " % len(tokens) + b" ".join(tokens[:DEPTH])
    return xxhash.xxh3_64_intdigest(head) - (1 << 63), tokens


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each leaf once per document."""
    for batch in batches:
        found: list[int] = []
        for raw in batch.column("text").cast(pa.binary()).to_pylist():
            found += {parse(line)[0] for line in raw.split(b"\n") if line.strip()}
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["leaf"])


def _lines(wanted: np.ndarray | None):
    """Lines of the wanted leaves with a key for each token at its place, and those keys that are new in the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if wanted is None else frozenset(wanted.tolist())
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows: list[tuple] = []
            columns = (batch.column("doc_id"), batch.column("text_hash"), batch.column("text").cast(pa.binary()))
            for doc_id, key, raw in zip(*(c.to_pylist() for c in columns), strict=True):
                row += 1
                seen: set[int] = set()
                for number, line in enumerate(raw.split(b"\n")):
                    leaf, tokens = parse(line)
                    if not tokens or known is not None and leaf not in known:
                        continue
                    places = [
                        xxhash.xxh3_64_intdigest(b"%d %d " % (leaf, i) + t) - (1 << 63) for i, t in enumerate(tokens)
                    ]
                    fresh = [x for x in dict.fromkeys(places) if x not in seen]
                    seen.update(fresh)
                    rows.append((doc_id, key, row, number, leaf, places, fresh))
            numbers = pa.list_(pa.int64())
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), numbers, numbers)
            parts = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(p), k) for p, k in zip(parts, kinds, strict=True)],
                names=["doc_id", "text_hash", "row", "line", "leaf", "places", "fresh"],
            )

    return run


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, stable: float = STABLE) -> DataFrame:
    """(doc_id, text_hash, line, template, n_docs, stays) of each line of a recurring template, lines counted from 0."""
    text = text_of(docs)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    leaves = source.select("text").mapInArrow(_leaves, "leaf bigint").groupBy("leaf").count()
    leaves = stored(leaves.where(F.col("count") >= min_docs).select("leaf"), "leaves")
    if leaves.count() <= LEAVES_TO_SEND:
        lines = source.mapInArrow(_lines(leaves.toPandas()["leaf"].to_numpy(np.int64)), LINES)
    else:
        lines = source.mapInArrow(_lines(None), LINES).join(leaves, "leaf", "left_semi")
    lines = stored(lines, "lines")

    counts = lines.select(F.explode("fresh").alias("place")).groupBy("place").count()
    constants = counts.where(F.col("count") >= min_docs).select("place")
    each = lines.select("doc_id", "text_hash", "row", "line", "leaf", F.size("places").alias("n"), F.explode("places").alias("place"))
    # Keys hold their place, so the set of a line's constants is its template, in whatever order they come.
    fitted = (
        each.join(constants, "place").groupBy("doc_id", "text_hash", "row", "line", "leaf", "n")
        .agg(F.count(F.lit(1)).alias("n_constant"), F.bit_xor("place").alias("constants"))
        .where(F.col("n_constant") >= stable * F.col("n"))
    )
    fitted = stored(
        fitted.select("doc_id", "text_hash", "row", "line", F.xxhash64("leaf", "n_constant", "constants").alias("template")), "fitted"
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "line")).alias("first")
    in_docs = fitted.groupBy("template", "row").agg(first)
    recurring = in_docs.groupBy("template").agg(F.count(F.lit(1)).alias("n_docs"), F.min("first").alias("first"))
    # Stored, so that lines of a very frequent template can be split when they are joined with it.
    recurring = stored(recurring.where(F.col("n_docs") >= min_docs), "recurring")
    stays = (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("text_hash") == F.col("first.text_hash"))
        & (F.col("line") == F.col("first.line"))
    )
    return fitted.join(recurring, "template").select(
        "doc_id", "text_hash", "line", "template", "n_docs", stays.alias("stays")
    )


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, stable: float = STABLE) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, and the text without recurring lines.

    Lines end at line feeds. Lines of white space alone are never dropped. A null text is an empty one, with one empty line.
    Every row counts as a document, also one that repeats another; rows that agree in id and text are cleaned alike. Reads
    doc_id and text only. An empty table gives no rows.
    """
    gone = recurring_lines(docs, min_docs, stable).where("NOT stays").groupBy(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")
    ).agg(F.collect_set("line").alias("gone"))
    text = text_of(docs)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    joined = rows.join(gone, same, "left").select("doc_id", F.split("text", "\n", -1).alias("lines"), "gone")
    left = F.filter("lines", lambda x, i: ~F.array_contains("gone", i))
    return joined.select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.array_join(F.when(F.col("gone").isNull(), F.col("lines")).otherwise(left), "\n").alias("text"),
    )

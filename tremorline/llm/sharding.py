"""Shards of bounded size by extendible hashing, in DataFrame operations only.

The directory is indexed by the leading bits of a hash of doc_id. A bucket whose documents come to more bytes
than the limit is split on the next bit, and only that one, until every bucket fits. Each round counts bytes
per cell (a prefix of a few more bits than are open), sums them up for all shorter prefixes, and gives each
cell its bucket: the shortest prefix that fits. Cells that do not fit go into the next round, with more bits.
Rows that agree in all bits are told apart by a hash of their text, and rows that agree in that too, copies of
one row, are numbered and dealt to pages of one shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremorline.llm.common import stored, text_of, unused

HASH_BITS = 60
SHARD_BYTES = 1 << 20
CELLS_TO_SEND = 200_000
ROWS = ["doc_id", "n_bytes", "lead", "h", "h2"]


def _hash(value: Column) -> Column:
    """The first 60 bits of the MD5 digest."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _bits(value: Column, width: int) -> Column:
    return F.lpad(F.conv(value.cast("string"), 10, 2), width, "0")


def _cells(rows: DataFrame, depth: int, step: int, limit: int) -> DataFrame:
    """For each cell the depth of its bucket: null if none fits yet, -1 if all its rows have one hash."""
    cells = rows.groupBy("lead", "cell").agg(
        F.sum("n_bytes").alias("load"), (F.min("h") == F.max("h")).alias("single")
    )
    first, last = (0 if depth == 0 else depth + 1), depth + step
    levels = cells.select(
        "lead", "cell", "load", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("level")
    ).withColumn("prefix", F.expr(f"shiftright(cell, {last} - level)"))
    nodes = levels.groupBy("lead", "level", "prefix").agg(F.sum("load").alias("total"))
    fitting = levels.join(nodes, ["lead", "level", "prefix"]).where(F.col("total") <= limit)
    found = fitting.groupBy("lead", "cell").agg(F.min("level").alias("level"))
    level = F.coalesce("level", F.when(F.col("single"), F.lit(-1)))
    return cells.join(found, ["lead", "cell"], "left").select("lead", "cell", level.alias("level"))


def _split(rows: DataFrame, limit: int, total: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Rows with their shard, and those whose hash alone cannot part them."""
    done, alike, depth = [], None, 0
    while rows is not None:
        step = max(4, math.ceil(math.log2(max(1, total / limit))) + 2) if depth == 0 else 4
        step = min(step, HASH_BITS - depth)
        rows = rows.withColumn("cell", F.shiftright("h", HASH_BITS - depth - step))
        depth += step
        cells = stored(_cells(rows, depth - step, step, limit), "cells")
        n, n_open, n_alike = cells.agg(
            F.count(F.lit(1)), F.count_if(F.col("level").isNull()), F.count_if(F.col("level") < 0)
        ).first()
        known = rows.join(F.broadcast(cells) if n <= CELLS_TO_SEND else cells, ["lead", "cell"])
        bits = F.substring(_bits(F.col("cell"), depth), F.lit(1), F.col("level"))
        done.append(
            known.where("level >= 0").select(
                "doc_id", "n_bytes", F.concat("lead", bits).alias("shard"), F.lit(0).cast("bigint").alias("page")
            )
        )
        if n_alike:
            same = known.where("level < 0").select(*ROWS)
            alike = same if alike is None else alike.unionByName(same)
        rows = stored(known.where("level IS NULL").select(*ROWS), "open") if n_open else None
    return done, alike


def shard_documents(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, shard (the bits of its bucket, ``root`` for none), page.

    A document larger than the limit gets a shard of its own, named by all bits of its hashes. A null or empty
    text counts no bytes; a null doc_id hashes like an empty one. ``page`` is 0 but for copies of one row that
    together exceed the limit. Reads doc_id and text only. An empty table gives no rows.
    """
    rows = stored(
        docs.select(
            "doc_id",
            F.octet_length(text_of(docs)).cast("bigint").alias("n_bytes"),
            F.lit("").alias("lead"),
            _hash(F.coalesce(docs["doc_id"].cast("string"), F.lit(""))).alias("h"),
            _hash(text_of(docs)).alias("h2"),
        ),
        "sizes",
    )
    total, n_large = rows.agg(F.sum("n_bytes"), F.count_if(F.col("n_bytes") > shard_bytes)).first()
    done, alike = _split(rows.where(F.col("n_bytes") <= shard_bytes), shard_bytes, total or 0)
    below = F.concat("lead", _bits(F.col("h"), HASH_BITS)).alias("lead")
    copies = rows.where(F.col("n_bytes") > shard_bytes).select("doc_id", "n_bytes", below, "h2") if n_large else None
    if alike is not None:
        more, same = _split(
            stored(alike.select("doc_id", "n_bytes", below, F.col("h2").alias("h"), "h2"), "alike"), shard_bytes, 0
        )
        done += more
        if same is not None:
            same = same.select("doc_id", "n_bytes", "lead", "h2")
            copies = same if copies is None else copies.unionByName(same)
    if copies is not None:
        each = F.greatest(F.lit(1), F.floor(F.lit(shard_bytes) / F.col("n_bytes")))
        counted = copies.groupBy("doc_id", "n_bytes", "lead", "h2").agg(F.count(F.lit(1)).alias("n"))
        dealt = counted.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("copy"))
        name = F.concat("lead", _bits(F.col("h2"), HASH_BITS))
        done.append(
            dealt.select("doc_id", "n_bytes", name.alias("shard"), F.floor(F.col("copy") / each).alias("page"))
        )
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.withColumn("shard", F.when(F.col("shard") == "", "root").otherwise(F.col("shard")))


def write_shards(docs: DataFrame, path: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the documents below ``path``, one folder per shard and page; returns the directory: shard, page, n_docs, n_bytes.

    Every row is written once, with all its columns. Folders are ``_shard=b<bits>`` (``b`` keeps the bits a text when they are read
    back) and ``_page=<number>``, with more leading underscores where the documents have such columns. No folder exceeds the limit
    unless it holds a single document: rows that share an id are placed by their text, copies of one row are numbered and dealt
    to pages. A null text is written as null and counts no bytes. An empty table writes no shard and returns no rows.
    """
    directory = stored(
        shard_documents(docs, shard_bytes).groupBy("shard", "page").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_bytes").alias("n_bytes")),
        "directory",
    )
    shard_name, page_name = (unused(c, docs) for c in ("_shard", "_page"))
    hashes = [_hash(F.coalesce(docs["doc_id"].cast("string"), F.lit(""))), _hash(text_of(docs))]
    rows = stored(
        docs.select(
            F.struct(*[docs[c] for c in docs.columns]).alias("row"),
            F.concat(*[_bits(h, HASH_BITS) for h in hashes]).alias("bits"),
            F.octet_length(text_of(docs)).cast("bigint").alias("n_bytes"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "numbered",
    )
    # A row's shard is the one whose name begins its bits. Names of shards that hold rows within the limit do not begin one
    # another; a row beyond the limit has a shard named by all its bits.
    named = directory.groupBy("shard").agg(F.max("page").alias("last")).withColumn("bits", F.regexp_replace("shard", "^root$", ""))
    depths = sorted(r[0] for r in named.select(F.length("bits")).distinct().collect())
    begins = F.transform(F.array(*[F.lit(d) for d in depths]).cast("array<int>"), lambda d: F.substring("bits", F.lit(1), d))
    begins = F.when(F.col("n_bytes") > shard_bytes, F.array("bits")).otherwise(begins)
    asked = rows.select("number", "n_bytes", F.explode(begins).alias("bits"))
    placed = stored(asked.join(F.broadcast(named) if named.count() <= CELLS_TO_SEND else named, "bits").drop("bits"), "placed")
    # Copies that fill pages are numbered by the part they were read in, so that no task numbers all of them.
    part = F.shiftright("number", 33)
    dealt = placed.where("last > 0").withColumn("part", part)
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.withColumn("offset", F.sum("n").over(before) - F.col("n")).drop("n")
    copy = F.row_number().over(W.partitionBy("shard", "part").orderBy("number")) - 1 + F.col("offset")
    each = F.greatest(F.lit(1), F.floor(F.lit(shard_bytes) / F.col("n_bytes")))
    paged = dealt.join(offsets, ["shard", "part"]).select("number", "shard", F.floor(copy / each).alias("page"))
    places = placed.where("last = 0").select("number", "shard", F.lit(0).cast("bigint").alias("page")).unionByName(paged)
    written = rows.join(places, "number").select(
        "row.*", F.concat(F.lit("b"), "shard").alias(shard_name), F.col("page").alias(page_name)
    )
    written.repartition(shard_name, page_name).write.partitionBy(shard_name, page_name).parquet(path)
    return directory


SQL = f"""
WITH sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), nodes AS (
  SELECT level, h >> ({HASH_BITS} - level) AS prefix, sum(n_bytes) AS total
  FROM sized, range(0, 25) AS levels(level) GROUP BY ALL
), homes AS (
  SELECT sized.doc_id, sized.n_bytes, sized.h, min(nodes.level)::INT AS depth
  FROM sized JOIN nodes ON nodes.prefix = sized.h >> ({HASH_BITS} - nodes.level)
  WHERE total <= {SHARD_BYTES} GROUP BY ALL
)
SELECT doc_id, n_bytes, 0::BIGINT AS page,
       CASE WHEN depth = 0 THEN 'root' ELSE substr(lpad(bin(h), {HASH_BITS}, '0'), 1, depth) END AS shard
FROM homes
"""

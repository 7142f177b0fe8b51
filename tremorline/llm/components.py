"""Connected components of a table of edges, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); the root is the smallest node reachable.

    Each round links all larger neighbours of a node to its smallest one, then all smaller neighbours, which
    turns every component into a star after a logarithmic number of rounds. Minima are taken before the
    shuffle and joined back, so that a node with very many neighbours is no group in one task.
    """
    found = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = _state(found)
    while state[0]:
        both = found.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        both = both.select("e.a", "e.b")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hooks = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.join(least, "a").select(F.explode(hooks).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        found, before = stored(small, "edges"), state
        state = _state(found)
        if state == before:
            break
    roots = found.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return found.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

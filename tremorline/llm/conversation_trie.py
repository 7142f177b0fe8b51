"""Prefix trie of conversations, as balanced parentheses per shard.

Every prefix of a conversation is a node, named by 128 bits: the sum of a hash of each of its turns and their positions. A
path is the names of its nodes from the root down, so paths sort with prefixes side by side. Equal paths are merged, with their
number and smallest conversation. Paths are dealt out by range of that order: a shard is a piece of the trie in preorder.

A shard writes its piece as balanced parentheses, one pair per node. The least excess of every block, and of pairs of blocks
up to the whole, lets ``findclose`` skip to the end of a subtree; the rank of leaf pairs between the two ends counts leaves, and
the difference of a running sum in preorder is what a subtree saves.

Only nodes on the first and the last path of a shard can go on in another one. All others are complete. Those two paths, the
spine, go to the next round with what hangs off each of their nodes summed up, where the spines of all shards are merged in the
same way; a round leaves two paths of each shard, and the last round is one shard.

Paths longer than ``BAND`` turns are cut in bands, so that no row grows with a conversation. The deepest band is done first;
what hangs below a cut is handed to the band above it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremorline.llm.common import stored
from tremorline.operators.blocks import number_rows

# A conversation takes its head from the first of its group of five; at most eight turns of it.
GROUP = 5
HEADS = 9

BAND = 1024
#: Nodes of a shard, and how many shards there may be; in larger tables shards grow.
SHARD = 30_000
MAX_SHARDS = 20_000
#: Excesses in a block of parentheses.
BLOCK = 64
#: Conversations that end in one node are hashed in pieces of so many ids.
IDS = 4096
#: Parents are sent to all tasks up to so many; beyond it they are joined by a shuffle.
PARENTS_TO_SEND = 500_000

_NONE = np.iinfo(np.int64).max
_ROOT = bytes(16)


class Parens:
    """Balanced parentheses with the least excess of each block and of ever larger runs of blocks."""

    def __init__(self, bits: np.ndarray):
        self.excess = np.cumsum(2 * bits.astype(np.int32) - 1)
        top = np.int32(np.iinfo(np.int32).max)
        self.blocks = np.append(self.excess, np.full(-len(bits) % BLOCK, top, np.int32)).reshape(-1, BLOCK)
        self.least = [self.blocks.min(axis=1)]
        while len(self.least[-1]) > 1:
            below = self.least[-1]
            self.least.append(np.append(below, np.full(len(below) % 2, top, np.int32)).reshape(-1, 2).min(axis=1))

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The position of the parenthesis that closes each of the opening ones."""
        found = np.empty(len(opens), np.int64)
        for at in range(0, len(opens), 1 << 14):
            found[at : at + (1 << 14)] = self._findclose(opens[at : at + (1 << 14)])
        return found

    def _findclose(self, opens: np.ndarray) -> np.ndarray:
        goal = self.excess[opens] - 1
        block = opens // BLOCK
        ends = (self.blocks[block] <= goal[:, None]) & (np.arange(BLOCK) > (opens % BLOCK)[:, None])
        found = block * BLOCK + ends.argmax(axis=1)
        far = np.flatnonzero(~ends.any(axis=1))
        if not len(far):
            return found
        # Up, until the run of blocks to the right reaches the goal; then down to the first block that does.
        node, level, open_ = block[far].copy(), np.full(len(far), -1), np.arange(len(far))
        for k, least in enumerate(self.least):
            right = node[open_] + 1
            hit = (right % 2 == 1) & (right < len(least))
            hit[hit] = least[right[hit]] <= goal[far[open_[hit]]]
            node[open_[hit]], level[open_[hit]] = right[hit], k
            open_ = open_[~hit]
            node[open_] //= 2
        for k in range(len(self.least) - 1, 0, -1):
            down = np.flatnonzero(level == k)
            left = 2 * node[down]
            node[down] = np.where(self.least[k - 1][left] <= goal[far[down]], left, left + 1)
            level[down] = k - 1
        found[far] = node * BLOCK + (self.blocks[node] <= goal[far][:, None]).argmax(axis=1)
        return found


#: A row of a round: a path with the bytes of its nodes, the conversations on it, what hangs below its end; spines say these
#: of every node in ``sums``.
PATHS = "path binary, sizes binary, n bigint, least bigint, end_kids bigint, end_leaves bigint, end_saved bigint, sums binary"
NODES = ("id binary, depth bigint, conv_id bigint, parent binary, parent_conv_id bigint, n_convs bigint, n_children bigint, "
         "n_leaves bigint, saved_tokens bigint")


def _sums(row: dict, length: int) -> np.ndarray:
    """For every node of a path: conversations, the smallest of them, children, leaves and savings beside the path."""
    if row["sums"] is not None:
        return np.frombuffer(row["sums"], np.int64).reshape(length, 5)
    sums = np.zeros((length, 5), np.int64)
    sums[:, 0], sums[:, 1] = row["n"], row["least"]
    sums[-1, 2:] = row["end_kids"], row["end_leaves"], row["end_saved"]
    return sums


def _solve(base: int, whole: bool):
    """The nodes of a shard whose numbers are final, and its two outer paths with what hangs off them.

    ``whole``: there are no other shards, so all nodes are final.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sizes, parents, depths, opened, members, sums = [], [], [], [], [], [], []
        before, on_path, n_nodes, n_bits = np.empty((0, 2), np.uint64), np.empty(0, np.int64), 0, 0
        leaf_bits, outer = [], []
        for batch in batches:
            for row in batch.to_pylist():
                path = np.frombuffer(row["path"], np.uint64).reshape(-1, 2)
                shared = min(len(path), len(before))
                same = (path[:shared] == before[:shared]).all(axis=1)
                common = shared if same.all() else int(same.argmin())
                n_bits += len(before) - common
                fresh = np.arange(n_nodes, n_nodes + len(path) - common)
                on_path = np.concatenate([on_path[:common], fresh])
                opened.append(n_bits + fresh - n_nodes)
                n_bits, n_nodes = n_bits + len(fresh), n_nodes + len(fresh)
                names.append(path[common:])
                sizes.append(np.frombuffer(row["sizes"], np.int64)[common:])
                depths.append(np.arange(common, len(path)))
                parents.append(np.concatenate([[-1], on_path])[common : len(path)])
                members.append(on_path)
                sums.append(_sums(row, len(path)))
                before = path
                outer = [on_path, on_path] if not outer else [outer[0], on_path]
        if not n_nodes:
            return
        n_bits += len(before)
        name, size, parent, depth = (np.concatenate(x) for x in (names, sizes, parents, depths))
        opens, member, given = np.concatenate(opened), np.concatenate(members), np.concatenate(sums)
        convs, kids, leaves, saved = (np.zeros(n_nodes, np.int64) for _ in range(4))
        least = np.full(n_nodes, _NONE)
        np.minimum.at(least, member, given[:, 1])
        for total, column in ((convs, 0), (kids, 2), (leaves, 3), (saved, 4)):
            np.add.at(total, member, given[:, column])
        edge = np.zeros(n_nodes, bool)
        if not whole:
            edge[outer[0]] = edge[outer[1]] = True
        bits = np.zeros(n_bits, np.uint8)
        bits[opens] = 1
        closes = Parens(bits).findclose(opens)
        # Leaf pairs "()" of nodes that have no children elsewhere either.
        pair = (closes == opens + 1) & (kids == 0) & ~edge
        leaf_bits = np.zeros(n_bits + 1, np.int64)
        leaf_bits[opens[pair] + 1] = 1
        rank = np.cumsum(leaf_bits)
        last = np.arange(n_nodes) + (closes - opens + 1) // 2

        def below(own: np.ndarray) -> np.ndarray:
            running = np.concatenate([[0], np.cumsum(own)])
            return running[last] - running[:-1]

        n_leaves = rank[closes + 1] - rank[opens] + below(leaves)
        n_saved = below(saved + np.where(edge, 0, (convs - 1) * size))
        kids += np.bincount(parent[~edge & (parent >= 0)], minlength=n_nodes).astype(np.int64)

        done = np.flatnonzero(~edge)
        up = parent[done]
        inside = up >= 0
        known = inside & ~edge[up] & ((base == 0) | (depth[up] > 0))
        ids = np.ascontiguousarray(name).view("V16").ravel()
        columns = [
            pa.array(ids[done].tolist(), pa.binary()),
            pa.array(base + depth[done]),
            pa.array(least[done]),
            pa.array([x if has else None for x, has in zip(ids[up].tolist(), inside, strict=True)], pa.binary()),
            pa.array(least[up], pa.int64(), mask=~known),
            *(pa.array(x[done]) for x in (convs, kids, n_leaves, n_saved)),
        ]
        nothing = pa.nulls(len(done), pa.binary())
        yield pa.RecordBatch.from_arrays([*columns, nothing, nothing, nothing], names=FIELDS)
        if whole:
            return
        # What hangs off an outer path is all below a node but for what is below its children on these paths.
        hang = {k: x.copy() for k, x in (("leaves", n_leaves), ("saved", n_saved))}
        inner = np.flatnonzero(edge & (parent >= 0))
        np.subtract.at(hang["leaves"], parent[inner], n_leaves[inner])
        np.subtract.at(hang["saved"], parent[inner], n_saved[inner])
        told = np.stack([convs, least, kids, hang["leaves"], hang["saved"]], axis=1)
        first, end = outer
        rows = [(first, told[first])]
        if not np.array_equal(first, end):
            values = told[end].copy()
            # Nodes on both paths are told once.
            values[np.isin(end, first)] = (0, _NONE, 0, 0, 0)
            rows.append((end, values))
        empty = [pa.nulls(len(rows), t) for t in (pa.binary(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5)]
        paths = [[name[p].tobytes() for p, _ in rows], [size[p].tobytes() for p, _ in rows], [v.tobytes() for _, v in rows]]
        yield pa.RecordBatch.from_arrays([*empty, *(pa.array(x, pa.binary()) for x in paths)], names=FIELDS)

    return run


SOLVED = f"{NODES}, path binary, sizes binary, sums binary"
FIELDS = [part.split()[0] for part in SOLVED.split(", ")]


def _trie(paths: DataFrame, base: int) -> DataFrame:
    """The nodes (NODES) of the trie of distinct paths that begin at depth ``base``; rows of parents elsewhere have no parent_conv_id."""
    found = []
    while True:
        nodes = paths.agg(F.coalesce(F.sum(F.length("path")), F.lit(0))).first()[0] // 16
        n = max(1, math.ceil(nodes / max(SHARD, math.ceil(nodes / MAX_SHARDS))))
        shards = paths.coalesce(1) if n == 1 else paths.repartitionByRange(n, "path")
        solved = stored(shards.sortWithinPartitions("path").mapInArrow(_solve(base, n == 1), SOLVED), "trie")
        names = [part.split()[0] for part in NODES.split(", ")]
        found.append(solved.where("id IS NOT NULL").select(*names))
        if n == 1:
            break
        zero = F.lit(0).cast("bigint")
        paths = solved.where("path IS NOT NULL").select(
            "path", "sizes", zero.alias("n"), zero.alias("least"),
            *[zero.alias(f"end_{x}") for x in ("kids", "leaves", "saved")], "sums",
        )
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _wrapped(total: Column) -> Column:
    """A sum of 64-bit numbers modulo 2 ** 64, as a signed number."""
    unsigned = F.pmod(total, F.lit("18446744073709551616").cast("decimal(38,0)"))
    half = F.lit("9223372036854775808").cast("decimal(38,0)")
    return F.when(unsigned >= half, unsigned - 2 * half).otherwise(unsigned).cast("bigint")


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, c1, c2, n_bytes) of all rebuilt turns, c1 and c2 naming role and text; and all conversations."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("c1"),
        F.conv(F.substring(digest, 16, 15), 16, 10).cast("bigint").alias("c2"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    numbered, _, _ = number_rows(stored(turns, "turns"), key="conv_id", order=("turn", "c1"), ties=("c2", "n_bytes"))
    turns = stored(numbered.select("conv_id", "pos", "c1", "c2", "n_bytes"), "numbered")
    heads = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS)).alias("h")
    convs = stored(turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("donor"), heads), "convs")
    given = turns.where((F.col("pos") < HEADS) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "donor")
    head = convs.join(given, "donor").where("pos < h").select("conv_id", "pos", "c1", "c2", "n_bytes")
    own = turns.withColumn("h", heads).where("pos >= h")
    # A donor with fewer turns leaves no gap.
    length = head.groupBy("conv_id").agg(F.count(F.lit(1)).alias("taken"))
    own = own.join(length, "conv_id", "left").select(
        "conv_id", (F.col("pos") - F.col("h") + F.coalesce("taken", F.lit(0))).alias("pos"), "c1", "c2", "n_bytes"
    )
    return head.unionByName(own), convs.select("conv_id")


def _bands(turns: DataFrame) -> DataFrame:
    """(conv_id, band, root, turns) of runs of BAND turns; root is the sum of the hashes before."""
    hashed = turns.select(
        "conv_id", F.floor(F.col("pos") / BAND).alias("band"), "pos", "n_bytes",
        F.xxhash64("c1", "c2", "pos").alias("a"), F.xxhash64("pos", "c2", "c1", F.lit("second")).alias("b"),
    )
    runs = hashed.groupBy("conv_id", "band").agg(
        F.sort_array(F.collect_list(F.struct("pos", "a", "b", "n_bytes"))).alias("turns"),
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(f"sum_{c}") for c in ("a", "b")],
    )
    before = W.partitionBy("conv_id").orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    return runs.select(
        "conv_id", "band", "turns",
        *[F.coalesce(_wrapped(F.sum(f"sum_{c}").over(before)), zero).alias(f"root_{c}") for c in ("a", "b")],
        (F.max("band").over(W.partitionBy("conv_id")) == F.col("band")).alias("ends"),
    )


RUNS = "conv_id bigint, band bigint, ends boolean, tip binary, path binary, sizes binary"


def _name_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns = batch.column("turns")
        lengths = turns.value_lengths().to_numpy(zero_copy_only=False)
        flat = turns.flatten()
        a, b, n_bytes = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "n_bytes"))
        roots = [batch.column(f"root_{c}").to_numpy(zero_copy_only=False) for c in ("a", "b")]
        tips, paths, sizes, at = [], [], [], 0
        for i, n in enumerate(lengths):
            path, size = np.empty((n + 1, 2), np.uint64), np.zeros(n + 1, np.int64)
            for k, (column, root) in enumerate(zip((a, b), roots, strict=True)):
                path[0, k] = root[i].astype(np.uint64)
                path[1:, k] = column[at : at + n].astype(np.uint64)
            np.cumsum(path, axis=0, out=path)
            size[1:] = n_bytes[at : at + n]
            tips.append(path[-1].tobytes())
            paths.append(path.tobytes())
            sizes.append(size.tobytes())
            at += n
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("band"), batch.column("ends"), *(pa.array(x, pa.binary()) for x in (tips, paths, sizes))],
            names=["conv_id", "band", "ends", "tip", "path", "sizes"],
        )


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the list of conversations that end in a node, from rows sorted by node and conversation."""
    rows, tip, ids = [], None, []

    def piece():
        if ids:
            rows.append((tip, ids[0], ",".join(map(str, ids))))

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())],
            names=["tip", "first", "ids"],
        )

    for batch in batches:
        for here, conv_id in zip(batch.column("tip").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if here != tip or len(ids) >= IDS:
                piece()
                tip, ids = here, []
            ids.append(conv_id)
        if rows:
            yield out()
            rows.clear()
    piece()
    if rows:
        yield out()


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's list, from its pieces in order."""
    tip, running, done = None, None, []

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in done], pa.binary()), pa.array([r[1] for r in done], pa.string())], names=["tip", "ends_sha256"]
        )

    for batch in batches:
        for here, ids in zip(batch.column("tip").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if here == tip:
                running.update(b",")
            else:
                if running is not None:
                    done.append((tip, running.hexdigest()))
                tip, running = here, hashlib.sha256()
            running.update(ids.encode())
        if done:
            yield out()
            done.clear()
    if running is not None:
        done.append((tip, running.hexdigest()))
        yield out()


def _ends(ends: DataFrame) -> DataFrame:
    pieces = ends.repartitionByRange("tip", "conv_id").sortWithinPartitions("tip", "conv_id")
    pieces = pieces.mapInArrow(_join_ids, "tip binary, first bigint, ids string")
    return pieces.repartition("tip").sortWithinPartitions("tip", "first").mapInArrow(_hash_ids, "tip binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of rebuilt conversations, the empty one included.

    Columns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    Conversation c has the first ``crc32(c) % 9`` turns of c - c % 5 (rounded towards zero) and its own turns after as many; turns
    go by ``turn``, a missing one first, and by content where that is equal. A null role or text is an empty one. Rows without a
    conv_id are left out. Equal turns that repeat in a conversation are turns of their own. A conversation whose rebuilt form has no turn is a
    member of the root. Reads conv_id, turn, role and text only. An empty table gives no rows.
    """
    turns, convs = rebuilt_turns(conversations)
    runs = stored(_bands(turns).mapInArrow(_name_nodes, RUNS), "runs")
    turnless = convs.join(runs.select("conv_id").distinct(), "conv_id", "left_anti")
    ends = runs.where("ends").select("tip", "conv_id").unionByName(turnless.select(F.lit(_ROOT).alias("tip"), "conv_id"))
    hashes = _ends(ends)
    rows = runs.groupBy("band", "tip", F.substring("path", 1, 16).alias("root")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.first("path").alias("path"), F.first("sizes").alias("sizes")
    )
    root = turnless.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).where("n > 0").select(
        F.lit(0).cast("bigint").alias("band"), F.lit(_ROOT).alias("tip"), F.lit(_ROOT).alias("root"), "n", "least",
        F.lit(_ROOT).alias("path"), F.lit(bytes(8)).alias("sizes"),
    )
    rows = stored(rows.unionByName(root), "paths")
    bands = rows.agg(F.max("band")).first()[0]
    if bands is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    nodes, below = None, None
    for band in range(bands, -1, -1):
        mine = rows.where(F.col("band") == band)
        hung = ["end_kids", "end_leaves", "end_saved"]
        if below is None:
            mine = mine.withColumns({c: F.lit(0).cast("bigint") for c in hung})
        else:
            mine = mine.join(below, "tip", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in hung})
        solved = _trie(mine.select("path", "sizes", "n", "least", *hung, F.lit(None).cast("binary").alias("sums")), band * BAND)
        if band:
            # The root of a deeper band is a node of the band above, which has all of its conversations.
            top = solved.where("parent IS NULL")
            below = top.select(
                F.col("id").alias("tip"), F.col("n_children").alias("end_kids"), F.col("n_leaves").alias("end_leaves"),
                F.col("saved_tokens").alias("end_saved"),
            )
            solved = solved.where("parent IS NOT NULL")
        nodes = solved if nodes is None else nodes.unionByName(solved)
    waiting = (F.col("parent").isNotNull()) & F.col("parent_conv_id").isNull()
    asked = nodes.where(waiting).select(F.col("parent").alias("id")).distinct()
    parents = stored(nodes.join(asked, "id").select(F.col("id").alias("of"), F.col("conv_id").alias("up")), "parents")
    parents = F.broadcast(parents) if parents.count() <= PARENTS_TO_SEND else parents
    settled = nodes.join(parents, nodes["parent"] == parents["of"], "left").join(hashes, F.col("id") == F.col("tip"), "left")
    return settled.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


RESULT = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
          "saved_tokens bigint, ends_sha256 string")


_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT for x in string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda acc, byte: list_reduce(list_prepend(xor(acc, byte), range(8)),
      lambda v, k: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT)"""

#: The same nodes by comparing every two of them.
SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS donor, {_CRC} % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = donor AND pos < h
  UNION ALL SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos >= h
),
n AS (
  SELECT conv_id, row_number() OVER w AS depth, octet_length(encode(text)) AS b,
         string_agg(md5(length(role) || ':' || role || text), '') OVER w AS node
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
),
e AS (SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
      FROM (SELECT conv_id, node FROM n QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY node),
v AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b FROM n GROUP BY ALL),
k AS (SELECT left(node, length(node) - 32) AS node, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY 1),
s AS (
  SELECT a.node, sum((u.n_convs - 1) * u.b)::BIGINT AS saved, count(*) FILTER (k.node IS NULL) AS n_leaves
  FROM v a JOIN v u ON starts_with(u.node, a.node) LEFT JOIN k ON k.node = u.node GROUP BY a.node
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM v JOIN s USING (node) LEFT JOIN k USING (node) LEFT JOIN e USING (node)
LEFT JOIN v p ON v.depth > 0 AND p.node = left(v.node, length(v.node) - 32)
"""

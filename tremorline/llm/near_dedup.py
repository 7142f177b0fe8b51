"""Near duplicates by a similarity join on chosen paths.

Documents are sets of word shingles. Equal sets are merged first, so copies cost one row per mapper. A set's
sketch is ``TOKENS`` minwise tokens. Every tree starts with one node for each value of one token; a node with
more than ``SMALL`` sets branches on tokens in which a few of its sets differ, chosen by a hash of its path: one or, so
that the expected number of branches is one over the similarity, sometimes two. Small nodes compare their sketches exhaustively, and the
trees are independent, which gives two similar sets many chances to meet: at the threshold itself a pair misses
all trees with probability (1 - t) ** TREES where nodes are small. A large node whose sets nearly all resemble one
of them branches no further: it is a group of near copies.

Sketches only say which sets may be linked. Sets that may be, directly or through others, form a candidate
group; the full sets of a group are fetched once and links confirmed on them. Groups of near copies, and nodes that stay
large at the deepest level, are candidate groups as a whole: that adds work, never a link. Large groups are confirmed in
blocks:

1. inside each block of ``BLOCK`` sets, which yields classes;
2. between one set of the largest class and all sets: classes that it reaches join it;
3. between all sets outside of that class and all sets.

After that any two sets in different classes have been compared. Searches stop at links that join classes, so no
group emits its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import keep_rows, stored, text_of
from tremorline.llm.components import components

WORDS = 5
TOKENS = 64
TREES = 10
SMALL = 64
DEPTH = 5
#: A large node looks at so many of its sets to choose what it branches on.
MEMBERS = 6
BLOCK = 128
#: A large node is a group of near copies if so many of its sets resemble the first of them.
ALIKE = 0.9
#: Candidates are sent to all tasks up to so many ids; beyond it they are joined by a shuffle.
IDS_TO_SEND = 1_000_000
GROUPS_TO_SEND = 500_000

_NUMBERS = np.random.default_rng(4).integers(0, 1 << 64, (TOKENS, 2), dtype=np.uint64)
_FACTORS, _SHIFTS = _NUMBERS[:, 0] | np.uint64(1), _NUMBERS[:, 1]
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(raw: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``words`` words; of all words if there are fewer."""
    parts = raw.lower().split()
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    if not parts:
        return hashed
    span = min(words, len(parts))
    total = np.full(len(parts) - span + 1, span, np.uint64)
    for k in range(span):
        total = total * _STEP + hashed[k : len(parts) - span + 1 + k]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(total ^ (total >> np.uint64(29)))


def sketch(members: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set, 32 bits each."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(members), 2048):
        least = np.minimum(least, (members[at : at + 2048, None] * _FACTORS + _SHIFTS).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sketches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, tokens = [], [], []
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                found = shingles(raw, words)
                sizes.append(len(found))
                ids.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                tokens.append(sketch(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(tokens, pa.list_(pa.int32()))],
                names=["doc_id", "text_hash", "n_shingles", "set_id", "tokens"],
            )

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Columns of each run of equal keys, whatever batches it spans."""
    held: dict[str, list] | None = None
    last = None
    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        labels = list(zip(*(columns[k] for k in keys), strict=True))
        start = 0
        for i in range(1, len(labels) + 1):
            if i < len(labels) and labels[i] == labels[start]:
                continue
            piece = {name: values[start:i] for name, values in columns.items()}
            if held is not None and last == labels[start]:
                for name, values in piece.items():
                    held[name] += values
            else:
                if held is not None:
                    yield held
                held, last = piece, labels[start]
            start = i
    if held is not None:
        yield held


def _edges(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], names=["a", "b"]
    )


def _find(parents: list[int], i: int) -> int:
    while parents[i] != i:
        parents[i] = parents[parents[i]]
        i = parents[i]
    return i


def _compare_sketches(agree: int):
    """In each node links of the sets that hang together over sketches with enough equal tokens, to their smallest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["node"]):
            tokens = np.array(group["tokens"], np.int32)
            left, out = list(range(len(tokens))), []
            while left:
                queue = [left.pop()]
                linked = list(queue)
                while queue and left:
                    i = queue.pop()
                    near = (tokens[left] == tokens[i]).sum(axis=1) >= agree
                    reached = [j for j, hit in zip(left, near, strict=True) if hit]
                    left = [j for j, hit in zip(left, near, strict=True) if not hit]
                    linked += reached
                    queue += reached
                first = min(group["set_id"][j] for j in linked)
                out += [(group["set_id"][j], first) for j in linked if group["set_id"][j] != first]
            if out:
                yield _edges(out)

    return run


def _similar(one: np.ndarray, others: list[np.ndarray], share: float) -> np.ndarray:
    """Which of the sorted sets are at least so similar to the first one."""
    sizes = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    common = np.add.reduceat((one[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    percent = round(100 * share)
    return 100 * common >= percent * (len(one) + sizes - common)


def _confirm_inside(share: float):
    """Each block's sets with their class, named by its smallest set; the sets themselves where more is to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["root", "block"]):
            sets = [np.frombuffer(x, np.uint64) for x in group["members"]]
            left, classes = list(range(len(sets))), [b""] * len(sets)
            while left:
                queue = [left.pop()]
                linked = list(queue)
                while queue and left:
                    i = queue.pop()
                    n = len(sets[i])
                    close = [j for j in left if share * n <= len(sets[j]) + 1 and share * len(sets[j]) <= n + 1]
                    if not close:
                        continue
                    hits = _similar(sets[i], [sets[j] for j in close], share)
                    reached = {j for j, hit in zip(close, hits, strict=True) if hit}
                    left = [j for j in left if j not in reached]
                    linked += reached
                    queue += reached
                name = min(group["set_id"][j] for j in linked)
                for j in linked:
                    classes[j] = name
            more = [x if n > BLOCK else None for x, n in zip(group["members"], group["n"], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(group["root"], pa.binary()), pa.array(group["n"], pa.int64()), pa.array(group["set_id"], pa.binary()),
                 pa.array(classes, pa.binary()), pa.array(more, pa.binary())],
                names=["root", "n", "set_id", "class", "members"],
            )

    return run


def _confirm_across(share: float):
    """In each cell links between the classes of asking sets and of others, until they are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["root", "asking", "block"]):
            sets = [np.frombuffer(x, np.uint64) for x in group["members"]]
            names = {c: k for k, c in enumerate(dict.fromkeys(group["class"]))}
            classes, parents = [names[c] for c in group["class"]], list(range(len(names)))
            asked = [i for i, asks in enumerate(group["asks"]) if not asks]
            out = []
            for i in (i for i, asks in enumerate(group["asks"]) if asks):
                n, mine = len(sets[i]), _find(parents, classes[i])
                close = [
                    j for j in asked
                    if _find(parents, classes[j]) != mine
                    and share * n <= len(sets[j]) + 1 and share * len(sets[j]) <= n + 1
                ]
                if not close:
                    continue
                for j, hit in zip(close, _similar(sets[i], [sets[j] for j in close], share), strict=True):
                    a, b = _find(parents, classes[i]), _find(parents, classes[j])
                    if hit and a != b:
                        parents[a] = b
                        out.append((group["class"][i], group["class"][j]))
            if out:
                yield _edges(out)

    return run


EDGES = "a binary, b binary"


def _member(k: int) -> Column:
    """The tokens of one set of a node, chosen by a hash that differs from node to node, so that trees stay independent."""
    return F.min(F.struct(F.xxhash64("node", "set_id", F.lit(k)).alias("h"), "tokens"))["tokens"].alias(f"member{k}")


def _best_tokens(members: Column, share: float) -> Column:
    """The tokens a node branches on: by a hash of the path, of those in which its sets looked at have ``MEMBERS`` / 2 values or more.

    One token, or sometimes two, so that there are one over the similarity of them on average.
    """
    def rank(i: Column) -> Column:
        values = F.transform(members, lambda tokens: F.get(tokens, i))
        differ = F.least(F.size(F.array_distinct(values)), F.lit(MEMBERS // 2))
        return F.struct((-differ).alias("rank"), F.xxhash64("node", i).alias("h"), i.alias("i"))

    ranked = F.transform(F.sort_array(F.transform(F.sequence(F.lit(0), F.lit(TOKENS - 1)), rank)), lambda x: x["i"])
    twice = F.pmod(F.xxhash64("node", F.lit("second")), F.lit(1000)) < round(1000 * (1 / share - 1))
    return F.slice(ranked, F.lit(1), F.when(twice, 2).otherwise(1))


def _candidates(sets: DataFrame, share: float) -> DataFrame:
    """Links between sets that may be similar."""
    agree = max(1, math.floor(TOKENS * (share - 6 * math.sqrt(share * (1 - share) / TOKENS))))
    rows = sets.select("set_id", F.posexplode(F.slice("tokens", 1, TREES)).alias("tree", "value")).select(
        "set_id", F.xxhash64("tree", "value").alias("node")
    )
    found = []
    for depth in range(1, DEPTH + 1):
        counts = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("set_id").alias("least")).where("n > 1")
        rows = rows.join(counts, "node")
        if depth == 1:
            rows = rows.join(sets.select("set_id", "tokens"), "set_id")
        rows = stored(rows, "nodes")
        small = rows.where(F.col("n") <= SMALL).select("node", "set_id", "tokens")
        grouped = small.repartition("node").sortWithinPartitions("node")
        found.append(grouped.mapInArrow(_compare_sketches(agree), EDGES))
        large = rows.where(F.col("n") > SMALL)
        if large.isEmpty():
            break
        shape = large.groupBy("node").agg(*[_member(k) for k in range(MEMBERS)])
        members = F.array(*[f"member{k}" for k in range(MEMBERS)])
        shape = shape.select("node", F.col("member0").alias("first"), _best_tokens(members, share).alias("chosen"))
        same = F.size(F.filter(F.zip_with("tokens", "first", lambda a, b: a == b), lambda x: x))
        judged = large.join(shape, "node").select("node", "set_id", "least", "tokens", "chosen", (same >= agree).alias("like"))
        shares = judged.groupBy("node").agg(F.avg(F.col("like").cast("int")).alias("alike"))
        judged = stored(judged.join(shares, "node").drop("like"), "judged")
        whole = F.lit(True) if depth == DEPTH else F.col("alike") >= ALIKE
        found.append(judged.where(whole).select(F.col("set_id").alias("a"), F.col("least").alias("b")))
        loose = judged.where(~whole)
        if loose.isEmpty():
            break
        rows = loose.select("node", "set_id", "tokens", F.explode("chosen").alias("token")).select(
            "set_id", "tokens", F.xxhash64("node", "token", F.get("tokens", "token")).alias("node")
        )
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def _block(n: str) -> Column:
    return F.pmod(F.xxhash64("set_id"), F.ceil(F.col(n) / BLOCK))


def _across(marked: DataFrame, share: float) -> DataFrame:
    """Links between classes, of the members of each group that ask and all its members, in cells of two blocks."""
    sizes = stored(
        marked.groupBy("root").agg(F.count_if("asks").alias("n_asking"), F.count(F.lit(1)).alias("n_all")).where("n_asking > 0"), "sizes"
    )
    marked = marked.join(F.broadcast(sizes) if sizes.count() <= GROUPS_TO_SEND else sizes, "root")
    asking = marked.where("asks").select(
        "root", "set_id", "members", "class", "asks", _block("n_asking").alias("asking"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n_all") / BLOCK) - 1)).alias("block"),
    )
    asked = marked.select(
        "root", "set_id", "members", "class", F.lit(False).alias("asks"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n_asking") / BLOCK) - 1)).alias("asking"),
        _block("n_all").alias("block"),
    )
    cells = asking.unionByName(asked).repartition("root", "asking", "block")
    return cells.sortWithinPartitions("root", "asking", "block").mapInArrow(_confirm_across(share), EDGES)


def _confirm(groups: DataFrame, share: float) -> DataFrame:
    """(set_id, class) of sets (root, n, set_id, members) in candidate groups."""
    parts = F.when(F.col("n") > BLOCK, F.ceil(F.col("n") / BLOCK)).otherwise(F.lit(1))
    blocks = groups.withColumn("block", F.pmod(F.xxhash64("set_id"), parts))
    inside = blocks.repartition("root", "block").sortWithinPartitions("root", "block")
    schema = "root binary, n bigint, set_id binary, class binary, members binary"
    labelled = stored(inside.mapInArrow(_confirm_inside(share), schema), "classes")
    large = labelled.where(F.col("n") > BLOCK)
    if large.isEmpty():
        return labelled.select("set_id", "class")
    sizes = large.groupBy("root", "class").agg(F.count(F.lit(1)).alias("size"))
    largest = stored(sizes.groupBy("root").agg(F.max(F.struct("size", "class"))["class"].alias("largest")), "largest")
    few = largest.count() <= GROUPS_TO_SEND
    known = large.join(F.broadcast(largest) if few else largest, "root")
    reached = stored(_across(known.withColumn("asks", F.col("set_id") == F.col("largest")), share).distinct(), "reached")
    joined = reached.select(F.col("b").alias("class"), F.col("a").alias("into"))
    few = joined.count() <= GROUPS_TO_SEND
    known = known.join(F.broadcast(joined) if few else joined, "class", "left")
    known = known.withColumn("class", F.coalesce("into", "class")).drop("into")
    rest = stored(_across(known.withColumn("asks", F.col("class") != F.col("largest")), share), "rest")
    names = components(reached.unionByName(rest)).withColumnsRenamed({"node": "class", "root": "name"})
    return labelled.select("set_id", "class").join(names, "class", "left").select(
        "set_id", F.coalesce("name", "class").alias("class")
    )


def _classified(docs: DataFrame, share: float, words: int) -> DataFrame:
    """The rows of ``near_groups`` and their class, which tells groups apart that share a smallest id; null without words."""
    text = text_of(docs)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    schema = "doc_id bigint, text_hash bigint, n_shingles bigint, set_id binary, tokens array<int>"
    rows = stored(source.mapInArrow(_sketches(words), schema), "sketches")
    sets = stored(
        rows.where("set_id IS NOT NULL").groupBy("set_id")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"), F.first("tokens").alias("tokens"))
        .select("set_id", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"), "tokens"), "sets"
    )
    roots = components(_candidates(sets, share))
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    wanted = stored(
        roots.join(sizes, "root").withColumnRenamed("node", "set_id").join(sets.select("set_id", "first_id", "first_hash"), "set_id"),
        "candidates",
    )

    def full_sets(batches):
        for batch in batches:
            found = [shingles(raw, words) for raw in batch.column("text").cast(pa.binary()).to_pylist()]
            same = [xxhash.xxh3_128_digest(x.tobytes()) == i for x, i in zip(found, batch.column("set_id").to_pylist(), strict=True)]
            bodies = [x.tobytes() if ok else None for x, ok in zip(found, same, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("root", "n", "set_id")), pa.array(bodies, pa.binary())],
                names=["root", "n", "set_id", "members"],
            )

    few = wanted.count() <= IDS_TO_SEND
    asked = wanted.select("first_id", "first_hash", "root", "n", "set_id")
    # By id and text: rows that share an id, or have none, meet their own sets only.
    own = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    texts = source.join(F.broadcast(asked) if few else asked, own)
    full = texts.select("root", "n", "set_id", "text").mapInArrow(full_sets, "root binary, n bigint, set_id binary, members binary")
    groups = stored(full.where("members IS NOT NULL").dropDuplicates(["root", "set_id"]), "members")
    classes = _confirm(groups, share)
    named = sets.select("set_id", "first_id").join(classes, "set_id", "left")
    named = stored(named.select("set_id", "first_id", F.coalesce("class", "set_id").alias("class")), "named")
    least = named.groupBy("class").agg(F.min("first_id").alias("least"))
    labels = named.join(least, "class").select("set_id", "class", F.col("least").alias("label"))
    joined = rows.select("doc_id", "text_hash", "n_shingles", "set_id").join(labels, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("label"))
    return joined.select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "class"
    )


def near_groups(docs: DataFrame, share: float = 0.85, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id, kept.

    Words are runs without white space, A-Z in lower case. Two documents are linked when the Jaccard similarity of
    their shingle sets is at least ``share`` (whole percents); component_id is the smallest doc_id reachable. A document
    without words, or with a null text, has no shingles and is linked with nothing. Rows of one set are always
    linked. Reads doc_id and text only; a null doc_id is not a smallest one. An empty table gives no rows.
    """
    return _classified(docs, share, words).drop("class")


def drop_near_copies(docs: DataFrame, share: float = 0.8, words: int = WORDS) -> DataFrame:
    """The documents with one of each group, columns unchanged; documents without words stay.

    Rows that repeat the id of the one that stays, with another text of the group, go too: the smallest hash stays.
    Groups that share a smallest id, or have none, are different groups.
    """
    groups = stored(_classified(docs, share, words), "near")
    kept = groups.where("kept AND n_shingles > 0").groupBy("doc_id", "class").agg(F.min("text_hash").alias("text_hash"))
    alone = groups.where("n_shingles = 0").select("doc_id", "class", "text_hash")
    return keep_rows(docs, kept.unionByName(alone))

"""Jaccard similarity join on word n-grams with a token-group matrix.

Two sets of similarity ``t`` share at least ``t`` of either. So whatever order all tokens are put in, both have ``k``
tokens in common among the first ``n - ceil(t n) + k`` of theirs. The order used here puts tokens that very many documents
hold last (counted over all documents), and ``k`` grows with the set, so that shared passages bring documents together only where
these have little else. A set that has not so many first tokens in common with any other has no partner.

The others are put into groups of similar sets, by the first token they share with very many, or else with any; in blocks where
that makes large groups. A group stores
the union of its members' tokens, its column of the token-group matrix, and the classes that its members form among themselves. A
set asks a group if they have so many first tokens in common and are not one class yet. The overlap with the union
bounds the overlap with any member; only groups that can reach the similarity are opened, and links are confirmed on whole sets.

First one set of every class asks one group of the largest class that shares a first token with it, which makes one class of most
groups of near copies at once. Then all sets ask the groups that hold sets of larger classes. Any two sets that could be linked
have then been compared or are in one class.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import BLANKS, stored, text_of
from tremorline.llm.components import components

WORDS = 3
SHARE = 0.9
#: First tokens that two similar sets have in common: so many, and one more for every so many tokens.
NEEDED = 3
EVERY = 50
#: Tokens that more documents hold come last; the limit is doubled until there are at most so many of them.
COMMON = 32
COMMON_TO_SEND = 2_000_000
#: Tokens counted by one task.
COUNTED = 8_000_000
GROUP = 128
#: Rounds in which one set of each class asks.
STARS = 2
#: Sets that ask one group are dealt to tasks of so many.
ASKING = 2048
#: Candidates are sent to all tasks up to so many ids; beyond it they are joined by a shuffle.
IDS_TO_SEND = 500_000
#: Columns of the matrix multiplied at once.
COLUMNS = 1 << 16


#: Bytes whose words are hashed at once.
PIECE = 1 << 20

_BLANK = np.isin(np.arange(256), np.frombuffer(BLANKS, np.uint8))
_BLANKS = re.compile(b"[" + re.escape(BLANKS) + b"]")
_BASE, _STEP = np.uint64(0x2127599BF4325C37), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, out=powers)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin, and their hashes. The text ends with a blank.

    A word's hash is a polynomial in its bytes, mixed: the difference of two running sums, brought down by the power at which it begins.
    """
    starts, hashes, at = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
    up = down = np.empty(0, np.uint64)
    while at < len(raw):
        cut = _BLANKS.search(raw, at + PIECE) if len(raw) - at > PIECE else None
        end = cut.end() if cut else len(raw)
        piece = np.frombuffer(raw, np.uint8, end - at, at)
        if len(up) < len(piece):
            up, down = (_powers(x, len(piece)) for x in (int(_BASE), pow(int(_BASE), -1, 1 << 64)))
        edges = np.flatnonzero(np.diff(_BLANK[piece].astype(np.int8), prepend=1))
        first, after = edges[::2], edges[1::2]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece + np.uint64(1)) * up[: len(piece)], out=sums[1:])
        hashes.append(_mixed((sums[after] - sums[first]) * down[first] + (after - first).astype(np.uint64) * _STEP))
        starts.append(first + at)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def token_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct runs of ``words`` words; of all words if there are fewer."""
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at < len(texts) and (not some or size + len(texts[at]) < PIECE):
            some.append(texts[at])
            size, at = size + len(texts[at]), at + 1
        starts, hashes = word_hashes(b"\n".join([*some, b""]).lower())
        bounds = np.searchsorted(starts, np.cumsum([0, *(len(x) + 1 for x in some)]))

        def runs(part: np.ndarray, span: int) -> np.ndarray:
            total = np.full(len(part) - span + 1, span, np.uint64)
            for k in range(span):
                total = total * _STEP + part[k : len(part) - span + 1 + k]
            return _mixed(total)

        every = runs(hashes, words) if len(hashes) >= words else hashes
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= words:
                yield np.unique(every[a : b - words + 1])
            else:
                yield runs(hashes[a:b], b - a) if b > a else hashes[:0]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _describe(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids = [], []
            for found in token_sets(_texts(batch), words):
                sizes.append(len(found))
                ids.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "set_id"],
            )

    return run


def _count_tokens(words: int, shift: int):
    """For each part of the token space the tokens of a run of documents, shortened, with the number that hold them."""

    def count(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens, times = np.unique(np.concatenate(held) >> np.uint64(shift), return_counts=True)
        parts = tokens >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
        ends = np.append(starts[1:], len(tokens))
        low, times = tokens.astype(np.uint32), times.astype(np.uint32)
        return pa.RecordBatch.from_arrays(
            [pa.array(parts[starts].astype(np.int64)), pa.array([low[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
             pa.array([times[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())],
            names=["part", "tokens", "times"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for found in token_sets(_texts(batch), words):
                held.append(found)
                n += len(found)
                if n >= COUNTED // 2:
                    yield count(held)
                    held, n = [], 0
        if n:
            yield count(held)

    return run


def _add_counts(least: int):
    """The tokens of one part that more than ``least`` documents hold."""

    def run(table: pa.Table) -> pa.Table:
        low = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("tokens").to_pylist()])
        times = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("times").to_pylist()])
        order = np.argsort(low, kind="stable")
        low, times = low[order], times[order].astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        total = np.add.reduceat(times, starts)
        many = total > least
        part = table.column("part")[0].as_py()
        return pa.table({"token": pa.array((part << 32) + low[starts[many]].astype(np.int64)), "df": pa.array(total[many])})

    return run


def _common_tokens(source: DataFrame, n_tokens: int, words: int) -> tuple[np.ndarray, int]:
    """Tokens that are held most, without their last bits, and how many bits these are."""
    more = max(0, math.ceil(math.log2(max(1, n_tokens / (256 * COUNTED)))))
    shift = 24 - more
    counts = source.mapInArrow(_count_tokens(words, shift), "part bigint, tokens binary, times binary")
    held = stored(counts.groupBy("part").applyInArrow(_add_counts(COMMON), "token bigint, df bigint"), "held")
    limits = [COMMON << k for k in range(40)]
    sizes = held.agg(*[F.count_if(F.col("df") > limit).alias(f"n{k}") for k, limit in enumerate(limits)]).first()
    limit = next(limit for limit, n in zip(limits, sizes, strict=True) if n <= COMMON_TO_SEND)
    tokens = held.where(F.col("df") > limit).select("token").toArrow().column("token").to_numpy()
    return np.sort(tokens.astype(np.uint64)), shift


def _needed(n: str, percent: int) -> Column:
    """First tokens that a set of ``n`` tokens has in common with any similar one, which may be smaller."""
    least = F.ceil(F.col(n) * percent / 100)
    return F.least(F.lit(NEEDED) + F.floor(least / EVERY), least)


def _first_tokens(words: int, percent: int, common: np.ndarray, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, first = [], [], []
            for found in token_sets(_texts(batch), words):
                n = len(found)
                if not n:
                    continue
                short = found >> np.uint64(shift)
                many = common[np.minimum(np.searchsorted(common, short), len(common) - 1)] == short if len(common) else np.zeros(n, bool)
                ordered = np.concatenate([found[~many], found[many]])
                ids.append(xxhash.xxh3_128_digest(found.tobytes()))
                sizes.append(n)
                first.append(ordered[: n + (-percent * n) // 100 + NEEDED + n // EVERY].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(first, pa.list_(pa.int64()))],
                names=["set_id", "n", "first"],
            )

    return run


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """(key, rows) of each run of equal keys; the rows are read as they come and need not be held."""
    rows = (row for batch in batches for row in batch.to_pylist())
    ahead = next(rows, None)
    while ahead is not None:
        key = tuple(ahead[k] for k in keys)

        def run():
            nonlocal ahead
            while ahead is not None and tuple(ahead[k] for k in keys) == key:
                yield ahead
                ahead = next(rows, None)

        mine = run()
        yield key, mine
        for _ in mine:
            pass


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The number of common tokens of every two sets."""
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, held = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = held[column] > 1
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    total = np.zeros((len(sets), len(sets)))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        matrix = np.zeros((len(sets), int(column[b - 1]) - at + 1), np.float32)
        matrix[owner[a:b], column[a:b] - at] = 1
        total += matrix @ matrix.T
    total = total.astype(np.int64)
    np.fill_diagonal(total, [len(x) for x in sets])
    return total


def _similar(common: np.ndarray, n: int | np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (n + sizes - common)


def _fill_groups(percent: int):
    """Each set of a group, once, with its class, named by its smallest set; on one row the group's union and smallest size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (group,), found in _runs(batches, ["grp"]):
            rows = list({r["set_id"]: r for r in found}.values())
            sets = [np.frombuffer(r["members"], np.uint64) for r in rows]
            sizes = np.array([len(x) for x in sets])
            near = _similar(overlaps(sets), sizes[:, None], sizes[None, :], percent)
            classes, left = [b""] * len(sets), set(range(len(sets)))
            while left:
                queue = [left.pop()]
                linked = list(queue)
                while queue:
                    reached = left.intersection(np.flatnonzero(near[queue.pop()]).tolist())
                    left -= reached
                    linked += reached
                    queue += reached
                name = min(rows[j]["set_id"] for j in linked)
                for j in linked:
                    classes[j] = name
            union = np.unique(np.concatenate(sets)).tobytes()
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([group] * n, pa.int64()), pa.array([r["set_id"] for r in rows], pa.binary()), pa.array(classes, pa.binary()),
                 pa.array([r["members"] for r in rows], pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array([union, *[None] * (n - 1)], pa.binary()), pa.array([int(sizes.min())] * n, pa.int64())],
                names=["grp", "set_id", "class", "members", "n", "tokens", "smallest"],
            )

    return run


def _shared_with(tokens: np.ndarray, union: np.ndarray) -> int:
    at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
    return int((union[at] == tokens).sum())


def _bound(percent: int):
    """The questions whose overlap with the union leaves room for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (group, _), rows in _runs(batches, ["grp", "salt"]):
            union, least, passed = None, 0, []
            for row in rows:
                if not row["asks"]:
                    union, least = np.frombuffer(row["members"], np.uint64), row["n"]
                    continue
                tokens = np.frombuffer(row["members"], np.uint64)
                # A link shares that part of the union of both, so of the larger one as well.
                if 100 * _shared_with(tokens, union) >= percent * max(len(tokens), least):
                    passed.append(row["set_id"])
            if passed:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(passed, pa.binary()), pa.array([group] * len(passed), pa.int64())], names=["set_id", "grp"]
                )

    return run


def _open(percent: int):
    """Links of the asking sets' classes with other classes of the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, ["grp", "salt"]):
            sets, classes, links = [], [], set()
            for row in rows:
                tokens = np.frombuffer(row["members"], np.uint64)
                if not row["asks"]:
                    sets.append(tokens)
                    classes.append(row["class"])
                    continue
                for other, name in zip(sets, classes, strict=True):
                    if name == row["class"] or (name, row["class"]) in links:
                        continue
                    n, m = len(tokens), len(other)
                    if 100 * min(n, m) >= percent * max(n, m) and _similar(_shared_with(tokens, other), n, m, percent):
                        links.add((name, row["class"]))
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for a, _ in links], pa.binary()), pa.array([b for _, b in links], pa.binary())], names=["a", "b"]
                )

    return run


def _with_bodies(wanted: DataFrame, bodies: DataFrame) -> DataFrame:
    """Rows of wanted with the members of their set; only of these sets members are sent anywhere."""
    wanted = stored(wanted, "wanted")
    few = wanted.count() <= IDS_TO_SEND
    return bodies.select("set_id", "members", "n").join(F.broadcast(wanted) if few else wanted, "set_id")


def _dealt(questions: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows of targets (grp, class, members, n), then the sets that ask them, by group and, where many ask, in parts."""
    columns = ["grp", "salt", "asks", "set_id", "class", "members", "n"]
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    targets = targets.select("*", copies.alias("salt"), F.lit(False).alias("asks"))
    asking = questions.select("*", F.pmod(F.xxhash64("set_id"), F.col("parts")).alias("salt"), F.lit(True).alias("asks"))
    rows = targets.select(*columns).unionByName(asking.select(*columns))
    return rows.repartition("grp", "salt").sortWithinPartitions("grp", "salt", "asks")


def _parts(questions: DataFrame) -> DataFrame:
    """The groups asked, and into how many parts those that ask them are dealt."""
    return questions.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / ASKING).alias("parts"))


def _links(questions: DataFrame, classes: DataFrame, bodies: DataFrame, unions: DataFrame, percent: int) -> DataFrame:
    """Links between classes (a, b) that the questions (set_id, grp) find."""
    named = classes.select("set_id", "class")

    def asking(questions: DataFrame, parts: DataFrame) -> DataFrame:
        return _with_bodies(questions.join(parts, "grp").join(named, "set_id"), bodies)

    parts = stored(_parts(questions), "parts")
    columns = unions.join(parts, "grp").select(
        "grp", "parts", F.lit(None).cast("binary").alias("set_id"), F.lit(None).cast("binary").alias("class"),
        F.col("tokens").alias("members"), F.col("smallest").alias("n"),
    )
    bound = _dealt(asking(questions, parts), columns).mapInArrow(_bound(percent), "set_id binary, grp bigint")
    passed = stored(bound, "passed")
    parts = stored(_parts(passed), "parts")
    opened = _with_bodies(classes.join(parts, "grp"), bodies)
    return stored(_dealt(asking(passed, parts), opened).mapInArrow(_open(percent), "a binary, b binary").distinct(), "links")


def _renamed(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (set_id, grp, class) after links between them."""
    names = components(links).select(F.col("node").alias("class"), "root")
    renamed = classes.join(names, "class", "left").select("set_id", "grp", F.coalesce("root", "class").alias("class"))
    return stored(renamed, "classes")


def _classes(source: DataFrame, sets: DataFrame, n_tokens: int, percent: int, words: int) -> DataFrame:
    """(set_id, class) of the sets that may have partners."""
    common, shift = _common_tokens(source, n_tokens, words)
    schema = "set_id binary, n bigint, first array<bigint>"
    prefixes = source.mapInArrow(_first_tokens(words, percent, common, shift), schema).groupBy("set_id").agg(
        *[F.first(c).alias(c) for c in ("n", "first")]
    )
    prefixes = stored(prefixes, "first-tokens")
    tokens = prefixes.select("set_id", "n", F.explode("first").alias("token"))
    several = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = stored(tokens.join(several.select("token"), "token"), "shared")

    # What a set has in common with any other: exactly where few sets hold a token, at most all of the others.
    sized = stored(shared.join(several, "token"), "sized")
    alike = F.min(F.struct((F.col("held") <= COMMON).alias("few"), "token"))["token"].alias("alike")
    crowded = sized.groupBy("set_id").agg(F.count_if(F.col("held") > COMMON).alias("crowded"), F.first("n").alias("n"), alike)
    few = sized.where(F.col("held") <= COMMON)
    pairs = few.select("token", "set_id").join(few.select("token", F.xxhash64("set_id").alias("other")), "token")
    pairs = pairs.where(F.xxhash64("set_id") != F.col("other")).groupBy("set_id", "other").agg(F.count(F.lit(1)).alias("met"))
    met = pairs.groupBy("set_id").agg(F.max("met").alias("met"))
    enough = F.col("crowded") + F.coalesce("met", F.lit(0)) >= _needed("n", percent)
    wanted = crowded.join(met, "set_id", "left").where(enough)
    wanted = stored(wanted.select("set_id", "alike"), "candidates")
    shared = stored(shared.join(wanted.select("set_id"), "set_id", "left_semi"), "shared")
    crowd = wanted.groupBy("alike").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("blocks"))
    grouped = wanted.join(crowd, "alike").select(
        "set_id", F.xxhash64("alike", F.pmod(F.xxhash64("set_id"), F.col("blocks"))).alias("grp")
    )
    grouped = stored(grouped.join(sets, "set_id"), "groups")

    def whole_sets(batches):
        for batch in batches:
            found = [x.tobytes() for x in token_sets(_texts(batch), words)]
            same = [xxhash.xxh3_128_digest(x) == i for x, i in zip(found, batch.column("set_id").to_pylist(), strict=True)]
            bodies = [x if ok else None for x, ok in zip(found, same, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("set_id"), batch.column("grp"), pa.array(bodies, pa.binary())], names=["set_id", "grp", "members"]
            )

    asked = grouped.select("set_id", "grp", F.col("of.doc_id").alias("first_id"), F.col("of.text_hash").alias("first_hash"))
    asked = F.broadcast(asked) if grouped.count() <= IDS_TO_SEND else asked
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    bodies = source.join(asked, same).select("set_id", "grp", "text").mapInArrow(whole_sets, "set_id binary, grp bigint, members binary")
    filled = bodies.where("members IS NOT NULL").repartition("grp").sortWithinPartitions("grp").mapInArrow(
        _fill_groups(percent),
        "grp bigint, set_id binary, class binary, members binary, n bigint, tokens binary, smallest bigint",
    )
    filled = stored(filled, "filled")
    bodies = filled.select("set_id", "members", "n")
    unions = filled.where("tokens IS NOT NULL").select("grp", "tokens", "smallest")
    classes = filled.select("set_id", "grp", "class")
    joined = True
    for turn in range(STARS + 1):
        if not joined and turn < STARS:
            continue
        # Of two classes the smaller one asks, by the same rule wherever they meet.
        rank = classes.groupBy("class").agg(F.count(F.lit(1)).alias("size")).select("class", F.struct("size", "class").alias("rank"))
        seen = stored(shared.join(classes.join(rank, "class").drop("class"), "set_id"), "seen")
        # Only where sets of several classes share a token anything is left to ask.
        if turn < STARS:
            one = F.min(F.struct(F.xxhash64("set_id", F.lit(turn)).alias("h"), "set_id", "grp")).alias("one")
            met = seen.groupBy("token", "rank").agg(one)
            top = met.groupBy("token").agg(F.max(F.struct("rank", "one.grp")).alias("top"), F.count(F.lit(1)).alias("classes"))
            asks = met.join(top.where("classes > 1"), "token").where(F.col("rank") < F.col("top.rank"))
            asks = asks.groupBy("rank", F.col("top.rank").alias("other")).agg(
                F.count(F.lit(1)).alias("met"), F.min(F.struct("one.h", "one.set_id", "top.grp")).alias("one")
            )
            questions = asks.where(F.col("met") >= NEEDED).select("one.set_id", "one.grp").distinct()
        else:
            several = seen.groupBy("token").agg(F.min("rank").alias("low"), F.max("rank").alias("high"))
            left = seen.join(several.where("low < high").select("token"), "token")
            # A group is asked if its largest class there is larger, whichever of its classes are.
            others = left.groupBy("token", "grp").agg(F.max("rank").alias("other"))
            pairs = left.select("token", "set_id", "n", "rank").join(others, "token").where(F.col("rank") < F.col("other"))
            pairs = pairs.groupBy("set_id", "grp").agg(F.count(F.lit(1)).alias("met"), F.first("n").alias("n"))
            questions = pairs.where(F.col("met") >= _needed("n", percent)).select("set_id", "grp")
        questions = stored(questions, "questions")
        if questions.isEmpty():
            break
        links = _links(questions, classes, bodies, unions, percent)
        joined = not links.isEmpty()
        classes = _renamed(classes, links) if joined else classes
    return classes.select("set_id", "class")


def ngram_groups(docs: DataFrame, share: float = SHARE, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id.

    Words are runs without white space, A-Z in lower case. Two documents are linked when the Jaccard similarity of
    their sets of ``words``-word shingles is at least ``share`` (whole percents); component_id is the smallest doc_id reachable. With
    fewer words the whole sequence is the one shingle. A document without words, or with a null text, has no shingles and is linked
    with nothing. Rows of one set are always linked, repeated rows among them; a null doc_id is not a smallest one. Long texts are
    taken whole. Reads doc_id and text only. An empty table gives no rows.
    """
    text = text_of(docs)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    schema = "doc_id bigint, text_hash bigint, n_shingles bigint, set_id binary"
    rows = stored(source.mapInArrow(_describe(words), schema), "described")
    sets = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("of"), F.min("doc_id").alias("first_id")
    )
    sets = stored(sets, "distinct")
    n_tokens = rows.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    classes = _classes(source, sets.select("set_id", "of"), n_tokens, round(100 * share), words)
    named = sets.select("set_id", "first_id").join(classes, "set_id", "left")
    named = stored(named.select("set_id", "first_id", F.coalesce("class", "set_id").alias("class")), "named")
    least = named.groupBy("class").agg(F.min("first_id").alias("least"))
    labels = named.join(least, "class").select("set_id", "least")
    return rows.join(labels, "set_id", "left").select(
        "doc_id", "text_hash", "n_shingles", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The same components from all pairs of documents that share a shingle.
SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    ELSE list_distinct([array_to_string(w[i : i + {WORDS} - 1], ' ') for i in range(1, greatest(len(w) - {WORDS} + 1, 1) + 1)]) END AS s FROM d
),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {round(100 * SHARE)} * (a.n + b.n - count(*))
),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT s.doc_id, any_value(len(s.s)) AS n_shingles, min(other) AS component_id FROM s JOIN r USING (doc_id) GROUP BY s.doc_id
"""

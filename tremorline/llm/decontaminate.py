"""Documents that hold a benchmark item, a few edits apart.

An item with an error budget of k edits is cut into k + 1 pieces: wherever it stands in a text with at most k
edits, one piece stands there unchanged (pigeonhole). All pieces of a block of items are searched in one pass over
each text by an automaton; around each hit Myers' bit-parallel algorithm computes the smallest edit distance
between the item and any stretch of the text. Before that a hit has to hold for its neighbours: of two groups
of p and q pieces with fewer than p + q edits together, one has fewer edits than pieces, so at least one hit stays
within its budget for two pieces, four, eight, and so on up to the item.

Every item has a budget in proportion to its length. Short items, which stand by chance inside longer words, are found
as whole words only: the stretch has to begin and end where no word goes on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import text_of, unused

#: Edits per character of an item that still count as the item.
ERROR_RATE = 0.1
#: Items with fewer characters are found between word boundaries only.
WHOLE_WORDS = 40
#: Two characters between which a word goes on; scripts that are written without spaces have a boundary anywhere.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
INSIDE_WORD = re.compile(f"[^\\W{_UNSPACED}]{{2}}")
#: Characters of items that are searched in one pass over the documents.
BLOCK_CHARS = 4_000_000
#: Parts of items whose masks a task remembers before it forgets them all.
MASKS = 100_000

MATCHES = "doc_id bigint, text_hash bigint, item_id bigint, distance int, ends_at bigint"


def plain(text: str) -> str:
    """Lower case, one space for each run of white space, none at the ends."""
    return " ".join(text.lower().split())


def budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(rate * len(item))


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item in ``errors + 1`` pieces of nearly equal length, with their places."""
    edges = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    """For each character the bits of the places where the item has it."""
    found: dict[str, int] = {}
    for i, c in enumerate(item):
        found[c] = found.get(c, 0) | 1 << i
    return found


def nearest(item_masks: dict[str, int], length: int, text: str, errors: int) -> tuple[int, int]:
    """The smallest edit distance between the item and a stretch of the text, and where the first such one ends.

    Columns of the table are kept as bits that say where it rises and falls; row 0 is zero, since a stretch may begin
    anywhere. Distances above ``errors`` are reported as ``errors + 1``.
    """
    full, top = (1 << length) - 1, 1 << (length - 1)
    rises, falls, score = full, 0, length
    best, place = errors + 1, -1
    for j, c in enumerate(text):
        same = item_masks.get(c, 0)
        diagonal = (((same & rises) + rises) ^ rises) | same | falls
        up = falls | (~(diagonal | rises) & full)
        down = rises & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        if score < best:
            best, place = score, j + 1
        up, down = up << 1, down << 1
        rises = (down | ~(diagonal | up)) & full
        falls = up & diagonal & full
    return best, place


def bounded(text: str, start: int, end: int) -> bool:
    """Whether no word goes on across either end of the stretch."""
    return not any(at and INSIDE_WORD.match(text, at - 1) for at in (start, end))


def whole_words(item: str, text: str, start: int, errors: int) -> tuple[int, int]:
    """The smallest distance between a short item and a stretch of whole words that begins within ``errors`` of ``start``."""
    best = errors + 1, -1
    for a in range(max(0, start - errors), start + errors + 1):
        if a > len(text) or (a and INSIDE_WORD.match(text, a - 1)):
            continue
        row = list(range(len(item) + 1))
        for b in range(a, min(len(text), a + len(item) + errors) + 1):
            if b > a:
                diagonal, row[0] = row[0], b - a
                for i, c in enumerate(item, 1):
                    diagonal, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, diagonal + (c != text[b - 1]))
            if row[-1] < best[0] and not (b and INSIDE_WORD.match(text, b - 1)):
                best = row[-1], b
    return best


class Finder:
    """Searches the texts of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float):
        self.items = []
        words: dict[str, list[tuple[int, int]]] = {}
        for number, (item_id, item) in enumerate(items):
            errors = budget(item, rate)
            cut = pieces(item, errors)
            self.items.append((item_id, item, errors, [at for at, _ in cut] + [len(item)]))
            for i, (_, piece) in enumerate(cut):
                words.setdefault(piece, []).append((number, i))
        self.masks: dict[tuple[int, int, int], dict[str, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for word, places in words.items():
            self.automaton.add_word(word, (len(word), places))
        if words:
            self.automaton.make_automaton()

    def distance(self, number: int, a: int, b: int, text: str, start: int, slack: int) -> tuple[int, int]:
        """Of the item's characters from a to b, around the place where they would stand if the item began at start."""
        found = self.masks.get((number, a, b))
        if found is None:
            if len(self.masks) >= MASKS:
                self.masks.clear()
            found = self.masks[number, a, b] = masks(self.items[number][1][a:b])
        lo = max(0, start + a - slack)
        distance, end = nearest(found, b - a, text[lo : start + b + slack], slack)
        return distance, lo + end

    def holds(self, number: int, piece: int, text: str, start: int) -> bool:
        """Whether the groups of pieces around a hit stay within their budgets."""
        edges = self.items[number][3]
        count, size = len(edges) - 1, 2
        while size < count:
            first = piece // size * size
            last = min(first + size, count)
            slack = last - first - 1
            if slack and self.distance(number, edges[first], edges[last], text, start, slack)[0] > slack:
                return False
            size *= 2
        return True

    def matches(self, text: str) -> list[tuple[int | None, int, int]]:
        """(item_id, distance, end) of the best stretch for each item within its budget."""
        if not self.items:
            return []
        starts: dict[int, dict[int, list[int]]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for number, piece in places:
                _, item, errors, cuts = self.items[number]
                start = end + 1 - length - cuts[piece]
                if errors or len(item) >= WHOLE_WORDS or bounded(text, start, end + 1):
                    starts.setdefault(number, {}).setdefault(start, []).append(piece)
        found = []
        for number, places in starts.items():
            item_id, item, errors, _ = self.items[number]
            if not errors:
                found.append((item_id, 0, min(places) + len(item)))
                continue
            best = errors + 1, -1
            for start in sorted(places):
                if any(self.holds(number, piece, text, start) for piece in places[start]):
                    near = self.distance(number, 0, len(item), text, start, errors)
                    if len(item) < WHOLE_WORDS and near[0] <= errors:
                        near = whole_words(item, text, start, errors)
                    if near[0] <= errors:
                        best = min(best, near)
            if best[0] <= errors:
                found.append((item_id, *best))
        return found


def _search(items: list[tuple[int | None, str]], rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(items, rate)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")), strict=True):
                out += [(doc_id, key, *match) for match in finder.matches(plain(text))]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "text_hash", "item_id", "distance", "ends_at"],
            )

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """One row per document and item it holds: doc_id, text_hash, item_id, distance, ends_at.

    Both sides are compared in lower case with white space runs as one space; ``ends_at`` counts in that text. Of several
    stretches the one with the smallest distance counts, then the first. Null and empty texts hold nothing and empty items
    are held by none. Every item may differ in ``rate`` of its characters; items of fewer than ``WHOLE_WORDS`` characters are
    found as whole words. Texts of any length are searched whole. An item without an id is reported with a null item_id, unless its text has an id in another row. Rows with repeated ids are
    judged one by one. Items are taken in blocks of ``BLOCK_CHARS`` characters, so the benchmark may be of any size. Only
    doc_id, item_id and text are read.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of(docs)).alias("text_hash"), text_of(docs).alias("text")
    )
    asked = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    named = asked.where("item_id IS NOT NULL")
    asked = named.unionByName(asked.where("item_id IS NULL").join(named.select("text"), "text", "left_anti").select("item_id", "text"))
    chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    found = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().collect()
        items = sorted(((r["item_id"], plain(r["text"])) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        items = [(i, text) for i, text in items if text]
        part = source.mapInArrow(_search(items, rate), MATCHES)
        found = part if found is None else found.unionByName(part)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The documents that hold no item, columns unchanged; null and empty texts, and rows without an id, are judged like others."""
    leaks = find_leaks(docs, benchmark, rate).select(F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash")).distinct()
    key = unused("text_hash", docs)
    marked = docs.withColumn(key, F.xxhash64(text_of(docs)))
    same = marked["doc_id"].cast("bigint").eqNullSafe(leaks["leak_id"]) & (marked[key] == leaks["leak_hash"])
    return marked.join(leaks, same, "left_anti").drop(key)

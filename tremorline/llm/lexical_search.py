"""Ranked lexical search by sequential reads of impact-sorted lists (no random access).

A document's terms are counted once, of those only that some item asks for, and kept as one row per document. From that
table come the statistics of the corpus, which fix the weight of a term and so the impact of every posting. A search task
takes the rows of its split in chunks of a bounded number of postings; a chunk is a set of documents with one list of
postings per term, highest impact first.

For each item the lists of its terms are read from the top, all of them a step further in every round. A document's score
lies between the sum of the impacts read of it and that sum plus, for each list in which it has not been met, the last impact
read there. Reading ends when no document outside the best ``k`` can reach them any more, documents not met at all included,
and the score of each that still can is settled. What was best in the chunks before is where the next one starts from. Chunks
hold different documents, so the best of all are among the best of each, which is a bounded number of rows to sort at the end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremorline.llm.common import stored, text_of

BEST = 50
#: Up to so many terms of all items the documents are counted for these terms only; beyond it for all their terms.
VOCABULARY = 2_000_000
#: Items are searched in blocks of about so many characters, which is what a task holds of them.
BLOCK_CHARS = 4_000_000
#: A task holds so many postings at a time.
POSTINGS = 4_000_000
#: Entries read of each list in the first round; each round doubles it.
STEP = 1024

# Term characters: ASCII letters and digits and all that is not ASCII; A-Z become a-z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats."""
    return raw.translate(_FOLD).split()


def _count_terms(wanted: frozenset[bytes] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, names, times, ends = [], [], [], [0]
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                words = terms_of(raw)
                lengths.append(len(words))
                found = Counter(words if wanted is None else filter(wanted.__contains__, words))
                names += found.keys()
                times += found.values()
                ends.append(len(names))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(names, pa.binary()).cast(pa.string())),
                 pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))],
                names=["doc_id", "n", "terms", "times"],
            )

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms_of(raw))) for raw in batch.column("text").cast(pa.binary()).to_pylist()]
        lists = pa.array(found, pa.list_(pa.binary())).cast(pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("block"), lists], names=["item", "block", "terms"])


def settle(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may be among the best ``k`` with at least ``floor``, and their scores, which are exact.

    ``lists`` hold (documents, impacts) by falling impact, every document once a list. At least the best ``k`` with a score
    above 0 are returned, and all that tie with the last of them.
    """
    lower = np.zeros(n_docs, np.int64)
    at, step = [0] * len(lists), STEP
    last = np.array([impacts[0] for _, impacts in lists], np.int64)
    while True:
        for i, (docs, impacts) in enumerate(lists):
            part = slice(at[i], at[i] + step)
            lower[docs[part]] += impacts[part]
            at[i] = min(len(docs), at[i] + step)
            last[i] = impacts[at[i] - 1] if at[i] < len(docs) else 0
        unmet = int(last.sum())
        kth = int(np.partition(lower, n_docs - k)[n_docs - k]) if n_docs > k else 0
        least = max(1, floor, kth)
        if unmet == 0:
            live = np.flatnonzero(lower >= least)
            return live, lower[live]
        if unmet < least:
            met = np.zeros(n_docs, np.int64)
            for i, (docs, _) in enumerate(lists):
                if last[i]:
                    met[docs[: at[i]]] += last[i]
            live = np.flatnonzero(lower + unmet - met >= least)
            if (met[live] == unmet).all():
                return live, lower[live]
        step *= 2


def _search(items: list[tuple[bytes, list[str]]], weights: dict[str, int], n_all: int, length_all: int, k: int):
    """Each task's best documents for every item."""
    names = sorted(weights)
    number = {name: i for i, name in enumerate(names)}
    wanted = [(key, [number[t] for t in terms if weights.get(t, 0) > 0]) for key, terms in items]
    weight = np.array([weights[t] for t in names], np.int64)

    def chunk(docs: list, lengths: list, terms: list, times: list, owners: list, best: list) -> None:
        ids, n = pa.concat_arrays(docs), np.concatenate(lengths)
        term, tf, doc = np.concatenate(terms), np.concatenate(times), np.concatenate(owners)
        share = 100 - 50 + (50 * n * n_all) // length_all
        impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * share[doc]))
        some = impact > 0
        term, impact, doc = term[some], impact[some], doc[some]
        order = np.lexsort((-impact, term))
        term, impact, doc = term[order], impact[order], doc[order]
        starts = np.searchsorted(term, np.arange(len(names) + 1))
        for i, (_, asked) in enumerate(wanted):
            lists = [(doc[a:b], impact[a:b]) for t in asked for a, b in [(starts[t], starts[t + 1])] if a < b]
            if not lists:
                continue
            floor = best[i][k - 1][0] if len(best[i]) >= k else 0
            live, scores = settle(lists, len(n), k, floor)
            found = list(zip(scores.tolist(), ids.take(pa.array(live)).to_pylist(), strict=True))
            # Highest score, then smallest id; a missing id last.
            best[i] = sorted(best[i] + found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int | None]]] = [[] for _ in wanted]
        kept: tuple[list, ...] = ([], [], [], [], [])
        values = pa.array(names, pa.string())
        n_docs = n_postings = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sizes = part.column("terms").value_lengths().to_numpy(zero_copy_only=False)
                term = pc.index_in(part.column("terms").flatten(), value_set=values)
                known = term.is_valid().to_numpy(zero_copy_only=False)
                kept[0].append(part.column("doc_id"))
                kept[1].append(part.column("n").to_numpy(zero_copy_only=False))
                kept[2].append(term.fill_null(0).to_numpy(zero_copy_only=False)[known].astype(np.int32))
                kept[3].append(part.column("times").flatten().to_numpy(zero_copy_only=False)[known])
                kept[4].append(np.repeat(np.arange(n_docs, n_docs + len(sizes), dtype=np.int32), sizes)[known])
                n_docs, n_postings = n_docs + len(sizes), n_postings + int(known.sum())
                if n_postings >= POSTINGS:
                    chunk(*kept, best)
                    kept, n_docs, n_postings = ([], [], [], [], []), 0, 0
        if n_postings:
            chunk(*kept, best)
        rows = [(key, *row) for (key, _), found in zip(wanted, best, strict=True) for row in found]
        if rows:
            item, score, doc_id = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.binary()), pa.array(doc_id, pa.int64()), pa.array(score, pa.int64())],
                names=["item", "doc_id", "score"],
            )

    return run


def search(docs: DataFrame, benchmark: DataFrame, k: int = BEST) -> DataFrame:
    """The ``k`` best documents for every item: item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters, digits and characters that are not ASCII, A-Z in lower case. A term weighs
    ``floor(1000 ln((2N + 2) / (2 df + 1)))``; its impact falls with the document's length. Equal scores stand by ascending
    doc_id, a missing one last. Only documents with a score above 0 are returned; a null or empty text has no terms, as an item
    or as a document, and gives no rows. Every row of documents is a document and every row of items an item, also where
    ids or texts repeat: of rows equal in id and score, either may have the earlier rank. Long texts are counted as a whole. Reads
    doc_id, item_id and text only. Empty tables give no rows.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", text_of(benchmark).alias("text"))
    items = items.withColumn("item", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    texts = stored(items.select("item", "text").distinct(), "items")
    chars = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    texts = texts.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n_blocks)))
    asked = stored(texts.mapInArrow(_item_terms, "item binary, block bigint, terms array<string>"), "item-terms")
    vocabulary = stored(asked.select("block", F.explode("terms").alias("term")).distinct(), "vocabulary")
    known = vocabulary.select("term").distinct()
    wanted = frozenset(r[0].encode() for r in known.collect()) if known.count() <= VOCABULARY else None

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    counted = source.mapInArrow(_count_terms(wanted), "doc_id bigint, n bigint, terms array<string>, times array<bigint>")
    counted = stored(counted.where("n > 0"), "counted")
    n_all, length_all = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighed = stored(vocabulary.join(held, "term"), "weighed")

    found = spark.createDataFrame([], "item binary, doc_id bigint, score bigint")
    for block in range(n_blocks):
        mine = [(bytes(r["item"]), r["terms"]) for r in asked.where(F.col("block") == block).collect()]
        weights = {
            r["term"]: math.floor(1000 * math.log((2 * n_all + 2) / (2 * r["df"] + 1)))
            for r in weighed.where(F.col("block") == block).collect()
        }
        if weights:
            found = found.unionByName(counted.mapInArrow(_search(mine, weights, n_all, length_all, k), found.schema))
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return items.select("item_id", "item").join(ranked, "item").select("item_id", "rank", "doc_id", "score")


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _terms_sql(table: str, name: str) -> str:
    return rf"""SELECT {name}, regexp_extract_all(translate(text, '{_LETTERS}', '{_LETTERS.lower()}'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM {table} WHERE text IS NOT NULL"""


#: The same ranking by sums over all postings.
SQL = f"""
WITH d AS ({_terms_sql("documents", "doc_id")}),
c AS (SELECT count(*) AS n_all, sum(len(terms))::BIGINT AS length_all FROM d WHERE len(terms) > 0),
p AS (SELECT doc_id, len(terms) AS n, term, count(*) AS tf FROM (SELECT doc_id, terms, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, n_all),
q AS (SELECT DISTINCT item_id, unnest(terms) AS term FROM ({_terms_sql("benchmark", "item_id")})),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_all) // length_all))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term), c GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {BEST}
"""

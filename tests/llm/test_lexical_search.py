import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.llm import data
from tremorline.llm import lexical_search
from tremorline.llm.lexical_search import search, settle, terms_of


def words(text):
    folded = "".join(c.lower() if c.isascii() else c for c in text or "")
    return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in folded).split(" ")


def plain(docs, items, k=50):
    """The definition: every document scored for every item."""
    counts = [(i, Counter(w for w in words(t) if w)) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_all, length_all = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_all) // length_all
            score = 0
            for t in set(words(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return out


def found(docs, items, **options):
    return [tuple(r) for r in search(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect()]


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, rank int")


def test_terms_are_those_of_the_pattern():
    assert terms_of("Äb-c_D9 x\x7f’é 日本 A".encode()) == ["Äb".encode(), b"c", b"d9\xc2\xa0x", "’é".encode(), "日本".encode(), b"a"]


@pytest.mark.parametrize("postings,step,vocabulary,chars", [(4_000_000, 1024, 2_000_000, 4_000_000), (3000, 4, 0, 3000)])
def test_equals_the_definition(spark, sf_dir, monkeypatch, postings, step, vocabulary, chars):
    """In one piece, and with small chunks, short steps, all terms kept and several blocks of items."""
    for name, value in (("POSTINGS", postings), ("STEP", step), ("VOCABULARY", vocabulary), ("BLOCK_CHARS", chars)):
        monkeypatch.setattr(lexical_search, name, value)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = [tuple(r) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()]
    assert sorted(found(docs, items)) == sorted(plain(*rows))
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    assert sorted(db.execute(lexical_search.SQL).fetchall()) == sorted(plain(*rows))


def test_reading_ends_with_settled_scores(monkeypatch):
    """Any lists, any step: the best k and all that tie with the last of them, with their full sums."""
    monkeypatch.setattr(lexical_search, "STEP", 1)
    rnd = random.Random(3)
    for _ in range(200):
        n_docs, k = rnd.randint(1, 40), rnd.randint(1, 8)
        total, lists = np.zeros(n_docs, np.int64), []
        for _ in range(rnd.randint(1, 6)):
            docs = np.array(rnd.sample(range(n_docs), rnd.randint(1, n_docs)))
            impacts = np.sort(np.array([rnd.randint(1, 4) for _ in docs], np.int64))[::-1]
            total[docs] += impacts
            lists.append((docs, impacts))
        live, scores = settle(lists, n_docs, k)
        assert (total[live] == scores).all()
        least = max(1, sorted(total)[-k] if n_docs >= k else 0)
        assert set(np.flatnonzero(total >= least)) <= set(live.tolist())


def test_reading_stops_early(monkeypatch):
    """Where one document leads in every list, the tails stay unread."""
    monkeypatch.setattr(lexical_search, "STEP", 2)
    impacts = np.array([100] * 2 + [1] * 1000, np.int64)
    read = []

    class Seen(np.ndarray):
        def __getitem__(self, key):
            read.append(key.stop if isinstance(key, slice) else 0)
            return super().__getitem__(key)

    docs = np.arange(1002).view(Seen)
    live, scores = settle([(docs, impacts), (docs, impacts)], 1002, 2)
    assert sorted(live.tolist()) == [0, 1] and scores.tolist() == [200, 200] and max(read) < 100


def test_odd_rows(spark):
    rows = [(7, "the FOX jumps; the dog", 1), (None, "wörd5 wörd976 end", 2), (7, None, 3), (8, "", 4), (9, "end end end", 5), (9, "end end end", 6)]
    got = found(data.odd(spark), items_of(spark, rows))
    expected = plain(data.TEXTS, [(i, t) for i, t, _ in rows])
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert sorted(found(data.odd(spark), items_of(spark, rows), k=2), key=repr) == sorted(plain(data.TEXTS, [(i, t) for i, t, _ in rows], 2), key=repr)


def test_ties_stand_by_id(spark):
    docs = data.plain(spark, [(i, "same words here") for i in (9, 3, None, 5)] + [(100 + i, "other text") for i in range(40)])
    assert found(docs, items_of(spark, [(1, "same", 0)]), k=3) == [(1, r, d, s) for (_, r, d, s) in plain(
        [(3, "same words here"), (5, "same words here"), (9, "same words here"), (None, "same words here"), *((100 + i, "other text") for i in range(40))],
        [(1, "same")], 3)]


def test_empty_tables(spark):
    assert found(data.empty(spark), items_of(spark, [(1, "a", 1)])) == []
    assert found(data.odd(spark), items_of(spark, [])) == []

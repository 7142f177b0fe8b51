import random

import corpus_pipeline
from tests.llm import data
from tremorline.llm import catalog
from tremorline.llm import decontaminate as dc


def distance(item, text):
    """The smallest edit distance between the item and any stretch of the text, by the whole table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, d in enumerate(item):
            new.append(min(row[i] + (d != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def mutated(rnd, text, edits, letters):
    text = list(text)
    for _ in range(edits):
        at, kind = rnd.randrange(len(text)), rnd.random()
        if kind < 0.4:
            text[at] = rnd.choice(letters)
        elif kind < 0.7:
            text.insert(at, rnd.choice(letters))
        elif len(text) > 1:
            del text[at]
    return "".join(text)


def test_bit_parallel_distance():
    rnd = random.Random(3)
    for _ in range(500):
        item = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
        text = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 30)))
        assert min(dc.nearest(dc.masks(item), len(item), text, len(item))[0], len(item)) == distance(item, text)


def test_pieces_find_every_item_within_its_budget():
    rnd, letters = random.Random(4), "abcdefgh "
    items = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(40, 90)))) for i in range(12)]
    finder = dc.Finder(items, 0.15)
    for _ in range(120):
        pad = ["".join(rnd.choice(letters) for _ in range(50)) for _ in range(2)]
        text = pad[0] + mutated(rnd, rnd.choice(items)[1], rnd.randint(0, 16), letters) + pad[1]
        want = {(i, distance(item, text)) for i, item in items if distance(item, text) <= dc.budget(item, 0.15)}
        assert {(i, d) for i, d, _ in finder.matches(text)} == want


def test_planted_items(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    texts = {r["doc_id"]: dc.plain(r["text"]) for r in docs.collect()}
    asked = {r["item_id"]: dc.plain(r["text"]) for r in items.collect()}
    exact = {(d, i) for d, t in texts.items() for i, item in asked.items() if item in t}
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in dc.find_leaks(docs, items).collect()}
    assert exact and exact == {pair for pair, d in found.items() if d == 0}
    monkeypatch.setattr(dc, "BLOCK_CHARS", 1000)
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in dc.find_leaks(docs, items).collect()} == found


def test_odd_rows_and_stage(spark):
    item = "Another text under the same id, with quite some words more than that"
    texts = [*data.TEXTS, (8, f"start {item.upper()} end"), (None, f"{item[:30]}x{item[30:]}")]
    docs = spark.createDataFrame(data.rows(texts), data.SCHEMA)
    asked = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, item), (4, "two words")], "item_id long, text string")
    got = sorted((r["doc_id"] or 0, r["item_id"], r["distance"]) for r in dc.find_leaks(docs, asked).collect())
    assert got == [(0, 1, 1), (8, 1, 0), (8, 4, 0), (11, 4, 0)]
    left = dc.drop_leaks(docs, asked)
    assert left.columns == docs.columns and left.count() == len(data.TEXTS) - 2
    assert dc.drop_leaks(data.empty(spark), asked).count() == 0
    assert dc.drop_leaks(docs, asked.limit(0)).count() == len(texts)


def test_short_items_and_items_without_an_id(spark, tmp_path):
    item = "quite a long question that nobody gave an id, but that stands in texts"
    docs = data.plain(spark, [(1, f"so: {item.upper()}!"), (2, "What  is\na Monad? A"), (3, "what is a monadic thing"), (4, "他说中文话"), (5, "")])
    asked = spark.createDataFrame([(None, item), (7, "what is a monad"), (None, "中文"), (8, " "), (9, "?")], "item_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    asked.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {tuple(r) for r in catalog.op3_decontaminate(spark, str(tmp_path)).collect()}
    assert got == {(1, None, 0, 4 + len(item)), (2, 7, 0, 15), (2, 9, 0, 16), (4, None, 0, 4)}
    assert sorted(r["doc_id"] for r in corpus_pipeline.leaks(spark, docs, str(tmp_path)).collect()) == [3, 5]


def whole_word_distance(item, text):
    """The smallest edit distance between the item and any stretch that no word goes on across, by trying all."""
    ends = [i for i in range(len(text) + 1) if dc.bounded(text, i, i)]
    return min((distance_between(item, text[a:b]) for a in ends for b in ends if a <= b), default=len(item))


def distance_between(one, other):
    row = list(range(len(one) + 1))
    for j, c in enumerate(other, 1):
        new = [j]
        for i, d in enumerate(one):
            new.append(min(row[i] + (d != c), row[i + 1] + 1, new[i] + 1))
        row = new
    return row[-1]


def test_short_items_with_edits_against_all_stretches():
    rnd, letters = random.Random(6), "abc  "
    items = sorted({dc.plain("".join(rnd.choice(letters) for _ in range(rnd.randint(3, 39)))) for _ in range(14)} - {""})
    finder = dc.Finder(list(enumerate(items)), 0.2)
    met = 0
    for _ in range(60):
        pad = ["".join(rnd.choice(letters) for _ in range(8)) for _ in range(2)]
        text = dc.plain(f"{pad[0]} {mutated(rnd, rnd.choice(items), rnd.randint(0, 5), letters)} {pad[1]}")
        want = {(i, d) for i, item in enumerate(items) if (d := whole_word_distance(item, text)) <= dc.budget(item, 0.2)}
        met += len(want)
        assert {(i, d) for i, d, _ in finder.matches(text)} == want
    assert met > 60


def test_no_step_between_39_and_40_characters(spark):
    for length in (30, 39, 40, 41):
        item = ("what is the name of that long river in the north of it " * 2)[: length - 1] + "x"
        wrong = item[:12] + "#" + item[13:]
        docs = data.plain(spark, [(1, f"so: {wrong}, he said"), (2, "nothing of the kind")])
        asked = spark.createDataFrame([(1, item)], "item_id long, text string")
        assert [(r["doc_id"], r["distance"]) for r in dc.find_leaks(docs, asked).collect()] == [(1, 1)]
        assert [r["doc_id"] for r in dc.drop_leaks(docs, asked).collect()] == [2]

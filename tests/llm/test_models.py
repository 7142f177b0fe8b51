"""The two trained classifiers, by what they say of rows they were not fitted on."""

import random
import zlib

import numpy as np

from tests.llm import data
from tremorline.llm import lang_id, quality


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = lang_id.identify(docs).collect()
    assert len(got) == len(langs) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_language_reads_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    network = lang_id.learn(docs)
    odd = data.plain(spark, data.TEXTS)
    first = lang_id.identify(odd.selectExpr("doc_id", "text", "'en' AS lang"), network).collect()
    second = lang_id.identify(odd.selectExpr("doc_id", "text", "'xx' AS lang", "1 AS score"), network).collect()
    assert first == second and len(first) == len(data.TEXTS)
    unknown = {r["lang_pred"] for r, (_, t) in zip(first, data.TEXTS, strict=True) if not any(c.isalpha() for c in t or "")}
    assert unknown == {"und"}


def test_nothing_to_learn_from(spark):
    docs = data.plain(spark, [(1, "some text"), (2, None)]).selectExpr("*", "CAST(NULL AS string) AS lang")
    assert {r["lang_pred"] for r in lang_id.identify(docs).collect()} == {"und"}
    assert lang_id.identify(data.empty(spark)).count() == 0
    assert lang_id.identify(data.odd(spark)).count() == len(data.TEXTS)


def test_quality_on_labels_not_used(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    used, open_ = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0").select("doc_id", "quality")
    rated = quality.rate_documents(docs, used).join(open_, "doc_id").collect()
    good = [r["kept"] for r in rated if r["quality"] == 1]
    poor = [r["kept"] for r in rated if r["quality"] == 0]
    assert sum(good) >= 0.995 * len(good) and sum(poor) <= 0.05 * len(poor)


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (9, 0), (9, 0), (None, 1), (6, None), (8, 0)], "doc_id long, quality int")
    assert quality.rate_documents(data.odd(spark), labels).count() == len(data.TEXTS)
    left = quality.drop_poor(data.odd(spark), labels)
    assert left.columns == data.odd(spark).columns
    assert quality.rate_documents(data.empty(spark), labels).count() == 0


def test_quality_without_labels_keeps_everything(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.drop_poor(data.odd(spark), none).count() == len(data.TEXTS)
    one_kind = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert quality.drop_poor(data.odd(spark), one_kind).count() == len(data.TEXTS)


def test_every_language_is_learned(spark):
    """More languages than are sampled in full: each has a document at least, and can be predicted."""
    rnd = random.Random(2)
    rows = []
    for k in range(300):
        words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{c}" for c in "aeiou"]
        rows += [(i * 300 + k, " ".join(rnd.choices(words, k=30)), f"l{k:03d}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = lang_id.learn(docs, sample_docs=1)
    assert list(network.languages) == sorted({r[2] for r in rows})


def test_quality_takes_one_row_of_each_id(spark):
    """Thousands of rows under one labelled id, or one other id, bring one row each to the sample."""
    docs = data.plain(spark, [(1, f"text {i}") for i in range(3000)] + [(2, f"other {i}") for i in range(3000)] + [(3, "!! $$ ##")])
    views = quality.features(docs)
    text, page, y = quality._arrays(views.join(spark.createDataFrame([(1, 1.0), (3, 0.0)], "doc_id long, quality double"), "doc_id"))
    assert len(text) == len(page) == len(y) == 2


def test_quality_is_cross_fitted_at_every_size():
    """Scores of pure noise stay near the share of good rows, also for few labels, where a fit on the same rows would be sure."""
    rnd = np.random.default_rng(8)
    for n in (2, 3, 12, 39, 40, 400):
        text, page = rnd.normal(size=(n, 24)), rnd.normal(size=(n, 34))
        y = (np.arange(n) % 2).astype(float)
        model = quality.co_train(text, page, y, rnd.normal(size=(50, 24)), rnd.normal(size=(50, 34)))
        scores = model.scores(rnd.normal(size=(500, 24)), rnd.normal(size=(500, 34)))[2]
        assert np.isfinite(scores).all() and (n < 12 or abs(scores.mean() - 0.5) < 0.25)
    same = quality.co_train(text[:6], page[:6], np.array([1.0, 1, 1, 1, 1, 0]), text[:0], page[:0])
    assert np.isfinite(same.scores(text, page)[2]).all()


def plain_network(network, raw):
    """Probabilities of one window: every filter at every place, the largest answer, then the last layer."""
    hidden = []
    for width in lang_id.WIDTHS:
        filters, bias = network.weights[f"filter{width}"], network.weights[f"bias{width}"]
        for f in range(lang_id.FILTERS):
            answers = [
                sum(network.weights["embedding"][raw[at + k]] @ filters[k, :, f] for k in range(width))
                for at in range(lang_id.WINDOW - width + 1)
            ]
            hidden.append(max(0.0, max(answers) + bias[f]))
    scores = np.exp(np.array(hidden) @ network.weights["last"] + network.weights["offset"])
    return scores / scores.sum()


def test_predictions_equal_a_plain_convolution(spark):
    """Also of texts longer than a window: the mean over windows, weighed by their letters."""
    network = lang_id.Network(["de", "en", "fr"])
    texts = ["a few words only", "Größe und Maß " * 9, "longer text that fills a window and then some more " * 4]
    frame = data.plain(spark, list(enumerate(texts))).selectExpr("*", "'en' AS lang")
    got = {r["doc_id"]: r for r in lang_id.identify(frame, network).collect()}
    for i, text in enumerate(texts):
        parts = lang_id.windows(lang_id.letters(text))
        weights = (parts != 0).sum(axis=1)
        want = sum(w * plain_network(network, p) for w, p in zip(weights, parts, strict=True)) / weights.sum()
        assert got[i]["lang_pred"] == network.languages[int(want.argmax())]
        assert abs(got[i]["score"] - want.max()) < 1e-4

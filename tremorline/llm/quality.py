"""Quality classification by co-training on two views of a document.

One classifier sees the text, the other what is known about the page: source, language, declared length. Both are fitted on
labelled documents; over rounds each labels the unlabelled documents it is sure of for the other. Each view is calibrated,
and the views are weighed against each other, by cross-fitting: on what views fitted without a labelled document say of it.
Then all documents are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import keep_rows, stored, text_of

#: The classifiers are fitted on about so many labelled documents, and exchange labels of so many others.
SAMPLE_LABELLED = 12_000
SAMPLE_OPEN = 12_000
ROUNDS = 3
SURE = 0.95
#: Documents with a lower score are rejected.
THRESHOLD = 0.5
BUCKETS = 16
#: Parts of the labelled documents, each judged by views fitted on the others.
FOLDS = 2

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_SIGNS = b"#$%&*@^~<>{}[]=\\+_"

FEATURES = "doc_id bigint, text_hash bigint, text_view array<float>, page_view array<float>"


def text_view(raw: bytes) -> list[float]:
    """Shares of kinds of characters and words, repetition, length."""
    words, n = raw.split(), max(1, len(raw))
    n_words = max(1, len(words))
    n_letters = n - len(raw.translate(None, _LETTERS))
    lines = raw.split(b"\n")
    shares = [
        (n_letters - (n - len(raw.translate(None, _UPPER)))) / max(1, n_letters),
        (n - len(raw.translate(None, _DIGITS))) / n,
        (n - len(raw.translate(None, _SIGNS))) / n,
        raw.count(b"!") / n_words,
        raw.count(b"|") / n_words,
        sum(map(eq, words, words[1:])) / n_words,
        sum(map(eq, words, words[2:])) / n_words,
        len(lines) / n_words,
        1 - len(set(lines)) / len(lines),
        (raw.count(b".") + raw.count(b",")) / n_words,
        n_letters / n,
    ]
    shares[0] = 1 - shares[0]
    length = np.log1p(n_words) / 10
    return [*shares, *(np.tanh(20 * np.array(shares)).tolist()), length, len(set(words)) / n_words, min(5.0, n / n_words / 10)]


def page_view(source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    """Source and language in buckets of a hash, the declared length."""
    row = [0.0] * (2 * BUCKETS + 2)
    row[xxhash.xxh32_intdigest(source or "") % BUCKETS] = 1.0
    row[BUCKETS + xxhash.xxh32_intdigest(lang or "") % BUCKETS] = 1.0
    row[-2], row[-1] = float(np.log1p(max(0, n_chars or 0)) / 10), float(n_chars is None)
    return row


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [text_view(raw) for raw in batch.column("text").cast(pa.binary()).to_pylist()]
        pages = [page_view(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("source", "lang", "n_chars")), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(texts, pa.list_(pa.float32())),
             pa.array(pages, pa.list_(pa.float32()))],
            names=["doc_id", "text_hash", "text_view", "page_view"],
        )


def features(docs: DataFrame) -> DataFrame:
    """Both views of every document; a missing metadata column is one of nulls."""
    def column(name: str, kind: str):
        return (F.col(name) if name in docs.columns else F.lit(None)).cast(kind).alias(name)

    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of(docs)).alias("text_hash"),
        text_of(docs).alias("text"), column("source", "string"), column("lang", "string"), column("n_chars", "bigint"),
    )
    return source.mapInArrow(_features, FEATURES)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Logistic:
    """Logistic regression on standardised columns, fitted by Newton steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        weights = np.zeros(z.shape[1])
        for _ in range(25):
            p = _sigmoid(z @ weights)
            slope = z.T @ (p - y) + penalty * weights
            bend = (z * (p * (1 - p))[:, None]).T @ z + penalty * np.eye(z.shape[1])
            step = np.linalg.solve(bend, slope)
            weights -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, weights)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1], -30, 30)


@dataclass
class Model:
    text: Logistic
    page: Logistic
    #: Calibration of each view, and the weights of the calibrated views.
    text_scale: Logistic
    page_scale: Logistic
    both: Logistic

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = self.text_scale.logit(self.text.logit(text)[:, None])
        b = self.page_scale.logit(self.page.logit(page)[:, None])
        return _sigmoid(a), _sigmoid(b), _sigmoid(self.both.logit(np.column_stack([a, b])))


def exchange(
    text: np.ndarray, page: np.ndarray, y: np.ndarray, open_text: np.ndarray, open_page: np.ndarray
) -> tuple[Logistic, Logistic]:
    """Both views, fitted on labelled rows and on those that the other view is sure of."""
    first, second = Logistic.fit(text, y), Logistic.fit(page, y)
    for _ in range(ROUNDS if len(open_text) else 0):
        by_text, by_page = _sigmoid(first.logit(open_text)), _sigmoid(second.logit(open_page))
        from_page = np.abs(by_page - 0.5) > SURE - 0.5
        from_text = np.abs(by_text - 0.5) > SURE - 0.5
        # Where the views contradict each other, neither teaches.
        from_page &= ~(from_text & ((by_text > 0.5) != (by_page > 0.5)))
        from_text &= ~(from_page & ((by_text > 0.5) != (by_page > 0.5)))
        first = Logistic.fit(np.concatenate([text, open_text[from_page]]), np.concatenate([y, by_page[from_page] > 0.5]))
        second = Logistic.fit(np.concatenate([page, open_page[from_text]]), np.concatenate([y, by_text[from_text] > 0.5]))
    return first, second


def co_train(text: np.ndarray, page: np.ndarray, y: np.ndarray, open_text: np.ndarray, open_page: np.ndarray) -> Model:
    """Views fitted on all labelled rows, calibrated on what views fitted on other rows say of each; two rows at least.

    Rows of each kind are dealt to the parts in turn, so that a part lacks a kind only where that kind has one row.
    """
    turn = np.where(y > 0.5, np.cumsum(y > 0.5), np.cumsum(y <= 0.5)) % FOLDS
    a, b = np.zeros((len(y), 1)), np.zeros((len(y), 1))
    for part in np.unique(turn):
        out = turn == part
        rest = ~out if not out.all() else out
        first, second = exchange(text[rest], page[rest], y[rest], open_text, open_page)
        a[out, 0], b[out, 0] = first.logit(text[out]), second.logit(page[out])
    text_scale, page_scale = Logistic.fit(a, y), Logistic.fit(b, y)
    both = Logistic.fit(np.column_stack([text_scale.logit(a), page_scale.logit(b)]), y)
    return Model(*exchange(text, page, y, open_text, open_page), text_scale, page_scale, both)


def _arrays(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row per id, that of the smallest text hash: however many rows share an id, the sample stays bounded."""
    one = F.min(F.struct("text_hash", "text_view", "page_view", "quality")).alias("one")
    got = rows.groupBy("doc_id").agg(one).select("doc_id", "one.*").toPandas().sort_values("doc_id", kind="stable")
    if not len(got):
        return np.zeros((0, 1)), np.zeros((0, 1)), np.zeros(0)
    return np.stack(got["text_view"]).astype(float), np.stack(got["page_view"]).astype(float), got["quality"].to_numpy(float)


def learn(views: DataFrame, labels: DataFrame) -> Model | float:
    """A model fitted on bounded samples of labelled and unlabelled documents, chosen by a hash of the id, one row per id.

    Without labels, or with labels of one kind only, the share of good documents (1 without labels) takes its place.
    Labels of one document are averaged; null labels are ignored.
    """
    rated = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")
    ).agg((F.avg("quality") >= 0.5).cast("double").alias("quality"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    n_rated, share = rated.agg(F.count(F.lit(1)), F.avg("quality")).first()
    if not n_rated:
        return 1.0
    n_docs = views.count()
    some = rated.where(place < SAMPLE_LABELLED / n_rated)
    text, page, y = _arrays(views.join(some, "doc_id"))
    if len(set(y.tolist())) < 2:
        return float(share)
    others = views.where(F.col("doc_id").isNotNull() & (place < SAMPLE_OPEN / n_docs)).join(rated, "doc_id", "left_anti")
    open_text, open_page, _ = _arrays(others.withColumn("quality", F.lit(0.0)))
    return co_train(text, page, y, open_text, open_page)


def _score(model: Model | float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n and isinstance(model, Model):
                views = [batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for c in ("text_view", "page_view")]
                scores = model.scores(*views)
            else:
                scores = (np.full(n, model if isinstance(model, float) else 0.0),) * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), *(pa.array(np.asarray(s, float)) for s in scores)],
                names=["doc_id", "text_hash", "text_score", "page_score", "score"],
            )

    return run


def rate_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, text_hash, the calibrated score of each view, their joint score, kept.

    Scores are probabilities that the document is good; it is kept at ``threshold`` or more. A null text counts as empty and
    is judged like any other. Without labels all documents are kept. Reads doc_id, text, source, lang and n_chars, the last three
    if they are there; of the labels doc_id and quality. Rows with repeated ids are judged one by one. An empty table
    gives no rows.
    """
    views = stored(features(docs), "views")
    scored = views.mapInArrow(
        _score(learn(views, labels)), "doc_id bigint, text_hash bigint, text_score double, page_score double, score double"
    )
    return scored.withColumn("kept", F.col("score") >= threshold)


def drop_poor(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, columns unchanged."""
    return keep_rows(docs, rate_documents(docs, labels, threshold).where("kept"))

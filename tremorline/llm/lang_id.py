"""Language identification by a small convolutional network over bytes, trained here in numpy.

Texts are reduced to lower-case letters and single spaces and read in windows of ``WINDOW`` bytes, all of them. Filters of
several widths run over the embedded bytes of a window; the largest answer of each filter goes into a softmax. A
document's prediction is the mean over its windows, weighted by their bytes.

A filter of width w is a sum of w table lookups, one per byte, so prediction multiplies nothing but the last layer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import stored, text_of

WINDOW = 96
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: The network is fitted on about so many documents of each language, and so many windows of each.
SAMPLE_DOCS = 300
SAMPLE_WINDOWS = 4
#: Beyond so many languages fewer documents of each are taken, one at least; every language is learned.
MANY_LANGUAGES = 256
#: Shares of languages are sent to all tasks up to so many; beyond it they are joined by a shuffle.
LANGUAGES_TO_SEND = 100_000
EPOCHS = 8
CHUNK = 1024

_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
UNKNOWN = "und"


def letters(text: str) -> bytes:
    """Lower case; everything in ASCII but letters becomes a space, runs of spaces one."""
    return b" ".join(text.lower().encode(errors="replace").translate(_LETTERS).split())


def windows(raw: bytes) -> np.ndarray:
    """All windows of a text, the last one filled up with zeros."""
    n = -(-len(raw) // WINDOW)
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def held_out(doc_id: Column) -> Column:
    """Whether the document is kept from learning."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


class Network:
    """Embedding, filters of several widths with the maximum over a window, softmax."""

    def __init__(self, languages: list[str], seed: int = 6):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.weights = {"embedding": rng.normal(0, 0.5, (256, EMBEDDING))}
        for width in WIDTHS:
            self.weights[f"filter{width}"] = rng.normal(0, (width * EMBEDDING) ** -0.5, (width, EMBEDDING, FILTERS))
            self.weights[f"bias{width}"] = np.zeros(FILTERS)
        self.weights["last"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages)))
        self.weights["offset"] = np.zeros(len(languages))

    def tables(self) -> dict[int, np.ndarray]:
        """For each width and place in the filter the answer to each byte."""
        return {w: (self.weights["embedding"] @ self.weights[f"filter{w}"]).astype(np.float32) for w in WIDTHS}

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.01) -> None:
        rng = np.random.default_rng(7)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
                step += 1
                for name, slope in self._slopes(x[rows], y[rows]).items():
                    first[name] += 0.1 * (slope - first[name])
                    second[name] += 0.001 * (slope**2 - second[name])
                    change = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] = self.weights[name] - rate * (1 - epoch / epochs) * change

    def _slopes(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n, slopes, pooled, peaks = len(x), {}, [], {}
        for width, table in self.tables().items():
            answers = sum(table[k][x[:, k : WINDOW - width + 1 + k]] for k in range(width))
            peaks[width] = answers.argmax(axis=1)
            pooled.append(np.take_along_axis(answers, peaks[width][:, None], axis=1)[:, 0] + self.weights[f"bias{width}"])
        hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
        error = softmax(hidden @ self.weights["last"] + self.weights["offset"])
        error[np.arange(n), y] -= 1
        error /= n
        slopes["last"], slopes["offset"] = hidden.T @ error, error.sum(axis=0)
        back = (error @ self.weights["last"].T) * (hidden > 0)
        slopes["embedding"] = np.zeros_like(self.weights["embedding"])
        for i, width in enumerate(WIDTHS):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            slopes[f"bias{width}"] = part.sum(axis=0)
            slopes[f"filter{width}"] = np.zeros_like(self.weights[f"filter{width}"])
            for k in range(width):
                at = x[np.arange(n)[:, None], peaks[width] + k]
                table = np.zeros((256, FILTERS))
                np.add.at(table, (at, np.arange(FILTERS)[None, :]), part)
                slopes[f"filter{width}"][k] = self.weights["embedding"].T @ table
                slopes["embedding"] += table @ self.weights[f"filter{width}"][k].T
        return slopes

    def predictor(self):
        """Probabilities of windows; widths read their bytes two at a time, from tables of all pairs."""
        pairs, singles = [], []
        for width, table in self.tables().items():
            both = [(table[k][:, None] + table[k + 1][None]).reshape(65536, FILTERS) for k in range(0, width - 1, 2)]
            pairs.append(both)
            singles.append(table[width - 1] if width % 2 else None)
        bias = np.concatenate([self.weights[f"bias{w}"] for w in WIDTHS]).astype(np.float32)
        last, offset = self.weights["last"].astype(np.float32), self.weights["offset"].astype(np.float32)

        def predict(x: np.ndarray) -> np.ndarray:
            out = np.empty((len(x), len(self.languages)), np.float32)
            for lo in range(0, len(x), CHUNK):
                part = x[lo : lo + CHUNK]
                two = part[:, :-1].astype(np.int32) * 256 + part[:, 1:]
                peaks = []
                for width, both, single in zip(WIDTHS, pairs, singles, strict=True):
                    n = WINDOW - width + 1
                    total = both[0].take(two[:, :n], axis=0)
                    for k, table in enumerate(both[1:], 1):
                        total += table.take(two[:, 2 * k : 2 * k + n], axis=0)
                    if single is not None:
                        total += single.take(part[:, width - 1 :], axis=0)
                    peaks.append(total.max(axis=1))
                out[lo : lo + CHUNK] = softmax(np.maximum(np.concatenate(peaks, axis=1) + bias, 0) @ last + offset)
            return out

        return predict


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some windows of each document, spread over its whole text."""
    for batch in batches:
        langs, found = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            all_of_it = windows(letters(text))
            places = np.unique(np.linspace(0, len(all_of_it) - 1, SAMPLE_WINDOWS).astype(int)) if len(all_of_it) else []
            found += [all_of_it[i].tobytes() for i in places]
            langs += [lang] * len(places)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], names=["lang", "piece"])


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """A network fitted on documents that are not held out and have a language; None if there are none.

    Takes about ``sample_docs`` documents of each language, chosen by a hash of id and text, and ``SAMPLE_WINDOWS`` windows of
    each. With more than ``MANY_LANGUAGES`` languages the sample stays as large in total, but for one document that each
    language has at least; so what reaches the driver is bounded by the number of languages.
    """
    known = docs.where(docs["lang"].isNotNull() & docs["text"].isNotNull() & ~held_out(docs["doc_id"])).select(
        docs["lang"].cast("string").alias("lang"), docs["text"].cast("string").alias("text"),
        (F.pmod(F.xxhash64(docs["doc_id"], docs["text"]), F.lit(1 << 30)) / (1 << 30)).alias("place"),
    )
    counts = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")), "languages")
    n_languages = counts.count()
    if not n_languages:
        return None
    each = sample_docs * min(1.0, MANY_LANGUAGES / n_languages)
    shares = counts.select("lang", F.greatest(F.lit(each) / F.col("n"), F.col("first")).alias("share"))
    shares = F.broadcast(shares) if n_languages <= LANGUAGES_TO_SEND else shares
    chosen = known.join(shares, "lang").where(F.col("place") <= F.col("share"))
    pieces = chosen.select("lang", "text").mapInArrow(_windows_of, "lang string, piece binary").toPandas()
    if not len(pieces):
        return None
    pieces = pieces.sort_values(["lang", "piece"])
    network = Network(sorted(pieces["lang"].unique()))
    x = np.frombuffer(b"".join(pieces["piece"].map(bytes)), np.uint8).reshape(-1, WINDOW)
    network.fit(x, np.searchsorted(network.languages, pieces["lang"].to_numpy(dtype=str)))
    return network


def _predict(network: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = network.predictor() if network else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            named, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for rows, x, weights, starts in _pieces(texts) if predict else ():
                votes = np.add.reduceat(predict(x) * weights[:, None], starts, axis=0)
                votes /= np.add.reduceat(weights, starts)[:, None]
                for i, vote in zip(rows, votes, strict=True):
                    named[i] = network.languages[int(vote.argmax())]
                    scores[i] = min(1.0, float(vote.max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(named, pa.string()), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def _pieces(texts: list[str | None], at_once: int = 32 * CHUNK):
    """Windows of texts that have letters, many texts at a time: rows, windows, their bytes, where each text starts."""
    rows, held, n = [], [], 0
    for i, text in enumerate(texts):
        raw = letters(text) if text else b""
        if not raw or not any(c.isalpha() for c in text):
            continue
        rows.append(i)
        held.append(windows(raw))
        n += len(held[-1])
        if n >= at_once:
            yield _together(rows, held)
            rows, held, n = [], [], 0
    if rows:
        yield _together(rows, held)


def _together(rows: list[int], held: list[np.ndarray]):
    x = np.concatenate(held)
    starts = np.concatenate([[0], np.cumsum([len(h) for h in held])[:-1]])
    return rows, x, (x != 0).sum(axis=1).astype(np.float32), starts


def identify(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (0 to 1).

    A null text and a text without letters is ``und`` with score 0, and so is everything if there is nothing to learn
    from. Predictions read the text alone. Without ``network`` one is fitted first, see ``learn``. Reads doc_id, text and
    lang only; repeated rows are predicted alike. An empty table gives no rows.
    """
    network = network or learn(docs)
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), text_of(docs).alias("text")
    )
    return source.mapInArrow(_predict(network), "doc_id bigint, held_out boolean, lang_pred string, score double")

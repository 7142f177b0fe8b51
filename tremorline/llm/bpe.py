"""Byte-pair encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last 32 bytes cuts texts where their content says so; documents that share a passage
share its chunks. Documents are brought together by their smallest chunk hash, so that those with much in
common meet in one task (partitions that grow too large are split by adaptive execution); there a chunk is
encoded once and its ids are used again wherever it returns.

What is encoded on its own can differ from the whole only near its ends. Between a printable ASCII character
and white space every text is cut before the merges, whatever stands around; such a place is an *anchor*. Each
join of two chunks is repaired by encoding the stretch between the anchors around it again; outside of it
both sides agree with the whole text. A chunk without anchors widens the stretch, up to the whole text.

Latin text goes through tiktoken with the ranks of the vocabulary, which there equals the tokenizers library, and
is looked up word by word, as it is cut before every white space anyway. Chunks with other letters, with further
white space or with a special token go through the library itself.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tremorline.llm.common import text_of

#: Chunks have 2 ** CHUNK_BITS bytes on average and at least SHORTEST.
CHUNK_BITS = 9
SHORTEST = 128
WINDOW = 32
#: A worker forgets its chunks when they come to so many bytes of text.
KNOWN_BYTES = 24 << 20
#: Fixed value: how texts are cut before the merges of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD = re.compile(rb"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
#: A worker remembers so many words, the first it meets, and none that are longer than this.
WORDS = 300_000
LONGEST_WORD = 64
#: Latin white space beyond ASCII.
OTHER_BLANKS = (b"\xc2\x85", b"\xc2\xa0")
#: Lead bytes up to this one belong to letters below U+0240.
LAST_LATIN = 0xC8

GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
PRINTED = (np.arange(256) > 32) & (np.arange(256) < 127)


class Words(dict):
    """The ids of a word with the white space before it, as packed numbers."""

    def __init__(self, encode, kind: str):
        super().__init__()
        self.encode, self.kind = encode, kind

    def __missing__(self, word: bytes) -> bytes:
        packed = array(self.kind, self.encode(word.decode())).tobytes()
        if len(self) < WORDS and len(word) <= LONGEST_WORD:
            self[word] = packed
        return packed


class Vocabulary:
    """A tokenizer file, its tokens as bytes, and a faster encoder where both are known to agree."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocab = content["model"]["vocab"]
        added = {x["id"]: x["content"] for x in content["added_tokens"]}
        as_byte = {c: b for b, c in enumerate(_byte_letters())}
        self.tokens = [b""] * (1 + max([*vocab.values(), *added]))
        for word, i in vocab.items():
            self.tokens[i] = word.encode() if i in added else bytes(as_byte[c] for c in word)
        for i, word in added.items():
            self.tokens[i] = word.encode()
        self.lengths = np.array([len(x) for x in self.tokens])
        self.decimal = [str(i).encode() for i in range(len(self.tokens))]
        self.special = [x.encode() for x in added.values()]
        ranks = {x: i for i, x in enumerate(self.tokens) if i not in added}
        merges = content["model"]["merges"]
        in_order = all(
            vocab["".join(m if isinstance(m, list) else m.split(" "))] == 256 + i for i, m in enumerate(merges)
        )
        self.kind = np.uint16 if len(self.tokens) <= 1 << 16 else np.uint32
        self.words = None
        if in_order:
            fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.words = Words(fast.encode_ordinary, "H" if self.kind is np.uint16 else "I")
        self.apart = [*self.special, *OTHER_BLANKS]

    def encode(self, raw: bytes, latin: bool) -> np.ndarray:
        if self.words is not None and latin and not any(x in raw for x in self.apart):
            return np.frombuffer(b"".join(map(self.words.__getitem__, WORD.findall(raw))), self.kind)
        return np.array(self.whole.encode(raw.decode(), add_special_tokens=False).ids, dtype=self.kind)

    def decode(self, ids: list[int]) -> bytes:
        """The text in UTF-8; bytes that form no character become replacement characters."""
        raw = b"".join(map(self.tokens.__getitem__, ids))
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode(errors="replace").encode()
        return raw


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


def vocabulary_path() -> str:
    """The vocabulary of the queries: a byte-level one of the public tokenizers installed on every node."""
    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Of the 32 bytes that end at each place, by doubling the span."""
    h = GEAR[data]
    span = 1
    while span < WINDOW:
        h[span:] += h[:-span] << np.uint32(span)
        span *= 2
    return h


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text starts."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), starts


def cut_points(data: np.ndarray, starts: np.ndarray) -> list[tuple[list[int], int]]:
    """For each text the offsets at which it is cut, and the smallest hash at its cuts."""
    first, last = int(starts[0]), int(starts[-1])
    h = rolling_hash(data[first:last])
    starts_char = (data[first:last] & 0xC0) != 0x80
    # A cut stands after the hashed window, before a byte that begins a character.
    chosen = np.flatnonzero((h[:-1] >> np.uint32(32 - CHUNK_BITS) == 0) & starts_char[1:]) + 1
    hashes = h[chosen - 1].tolist()
    places = (chosen + first).tolist()
    limits = np.searchsorted(chosen + first, starts)
    found = []
    for i in range(len(starts) - 1):
        begin, end, cuts, least = int(starts[i]), int(starts[i + 1]), [], None
        previous = begin
        for k in range(limits[i], limits[i + 1]):
            if places[k] - previous >= SHORTEST and places[k] < end:
                previous = places[k]
                cuts.append(previous - begin)
                least = hashes[k] if least is None else min(least, hashes[k])
        if least is None:
            digest = hashlib.blake2b(data[begin:end].tobytes(), digest_size=8).digest()
            least = int.from_bytes(digest, "big") >> 1
        found.append((cuts, least))
    return found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        found = cut_points(*_texts(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), pa.array([c for c, _ in found], pa.list_(pa.int32())),
             pa.array([least for _, least in found], pa.int64())],
            names=["doc_id", "text", "cuts", "meet"],
        )


def _stretches(joins: np.ndarray, anchors: np.ndarray, end: int) -> list[tuple[int, int]]:
    """Between the anchors around each join; stretches that meet are one. A join at an anchor needs none."""
    after = np.searchsorted(anchors, joins, side="left")
    before = np.searchsorted(anchors, joins, side="right") - 1
    merged: list[tuple[int, int]] = []
    for lo, hi in zip(before.tolist(), after.tolist(), strict=True):
        a = int(anchors[lo]) if lo >= 0 else 0
        b = int(anchors[hi]) if hi < len(anchors) else end
        if a == b:
            continue
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


class Encoder:
    """Encodes texts chunk by chunk; remembers the ids of chunks, and where their tokens end."""

    def __init__(self, vocabulary: Vocabulary, known_bytes: int = KNOWN_BYTES):
        self.vocabulary, self.limit = vocabulary, known_bytes
        self.known: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        self.held = self.encoded = 0

    def chunk(self, raw: bytes, latin: bool) -> tuple[np.ndarray, np.ndarray]:
        found = self.known.get(raw)
        if found is None:
            ids = self.vocabulary.encode(raw, latin)
            found = ids, np.cumsum(self.vocabulary.lengths[ids])
            self.encoded += len(raw)
            self.held += len(raw)
            if self.held > self.limit:
                self.known, self.held = {}, len(raw)
            self.known[raw] = found
        return found

    def text(self, raw: bytes, cuts: list[int]) -> np.ndarray:
        data = np.frombuffer(raw, np.uint8)
        latin = not len(data) or int(data.max()) <= LAST_LATIN
        edges = [0, *cuts, len(raw)]
        if not cuts:
            return self.chunk(raw, latin)[0]
        anchors = np.flatnonzero(PRINTED[data[:-1]] & BLANK[data[1:]]) + 1
        repairs = _stretches(np.array(cuts), anchors, len(raw))
        parts, at = [], 0  # at: everything before this byte is in parts
        chunks = iter(zip(edges, edges[1:], strict=False))
        lo, hi = next(chunks)
        for a, b in [*repairs, (len(raw), len(raw))]:
            while at < a:  # tokens of whole chunks up to the stretch
                while hi <= at:
                    lo, hi = next(chunks)
                ids, ends = self.chunk(raw[lo:hi], latin)
                first = int(np.searchsorted(ends, at - lo, side="right"))
                stop = min(a, hi)
                last = int(np.searchsorted(ends, stop - lo, side="right"))
                parts.append(ids[first:last])
                at = stop
            if a < b:
                parts.append(self.vocabulary.encode(raw[a:b], latin))
                at = b
        return np.concatenate(parts)


def _encode(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        encoder = Encoder(words)
        for batch in batches:
            counts, first, second = [], [], []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for raw, cuts in zip(texts, batch.column("cuts").to_pylist(), strict=True):
                ids = encoder.text(raw, cuts)
                counts.append(len(ids))
                if digests:
                    listed = ids.tolist()
                    first.append(hashlib.sha256(b",".join(map(words.decimal.__getitem__, listed))).hexdigest())
                    second.append(hashlib.sha256(words.decode(listed)).hexdigest())
                else:
                    first.append(ids)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64())]
            if digests:
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(first, pa.string()), pa.array(second, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
            else:
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                flat = pa.array(np.concatenate([*first, np.zeros(0, words.kind)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "n_tokens", "ids"]
                )

    return run


def encode_documents(docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, and its ids; or, with ``digests``, those of ids and decoded text.

    ``path`` is a byte-level vocabulary file of the tokenizers library that every executor can read. The ids
    are those of encoding the whole text without added special tokens; a special token's own text counts as the token.
    A null text is an empty one and has no ids. Reads doc_id and text only. An empty table gives no rows.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    cut = source.mapInArrow(_cut, "doc_id bigint, text string, cuts array<int>, meet bigint")
    met = cut.hint("rebalance", F.col("meet")).drop("meet")
    schema = "doc_id bigint, n_tokens bigint, " + (
        "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    )
    return met.mapInArrow(_encode(path, digests), schema)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """The texts of encoded documents: doc_id, text. Null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [None if ids is None else words.decode(ids).decode() for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")

import hashlib
import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm import data
from tremorline.llm import bpe

PATH = bpe.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_latin_letters_agree_with_the_library():
    words = bpe.vocabulary(PATH).words
    for c in map(chr, range(0x240)):
        text = f"a{c}b {c}{c} 1{c}\n {c}  x{c} '{c}s !{c}? "
        assert words.encode(text) == library(text)


@pytest.mark.parametrize(("shortest", "bits"), [(128, 9), (4, 2), (1, 1)])
def test_joined_chunks_agree_with_the_library(monkeypatch, shortest, bits):
    monkeypatch.setattr(bpe, "SHORTEST", shortest)
    monkeypatch.setattr(bpe, "CHUNK_BITS", bits)
    rnd = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\t", "'s", "'re", "'", "!", "1", "é", " ", "\u0085", "中", "𝄞", " ", "́",
             "<|endoftext|>", "<|endof", "text|>", " \n ", "x" * 30]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 300))) for _ in range(400)]
    cuts = bpe.cut_points(*bpe._texts(pa.array(texts)))
    encoder = bpe.Encoder(bpe.vocabulary(PATH), known_bytes=2000)
    for text, (places, _) in zip(texts, cuts, strict=True):
        ids = encoder.text(text.encode(), places).tolist()
        assert ids == library(text)
        assert bpe.vocabulary(PATH).decode(ids).decode() == LIBRARY.decode(ids, skip_special_tokens=False)


def test_shared_chunks_are_encoded_once():
    rnd = random.Random(2)
    passage = " ".join(f"word{rnd.randint(0, 10**6)}" for _ in range(2000))
    texts = [f"{passage} tail {i}" for i in range(20)]
    encoder = bpe.Encoder(bpe.vocabulary(PATH))
    for text, (cuts, _) in zip(texts, bpe.cut_points(*bpe._texts(pa.array(texts))), strict=True):
        assert encoder.text(text.encode(), cuts).tolist() == library(text)
    assert encoder.encoded < 2 * len(passage)


def test_odd_rows_and_round_trip(spark):
    encoded = bpe.encode_documents(data.odd(spark), PATH)
    got = sorted(((r["doc_id"] or 0), r["n_tokens"], list(r["ids"])) for r in encoded.collect())
    assert got == sorted(((i or 0), len(library(t)), library(t)) for i, t in data.TEXTS)
    back = sorted(((r["doc_id"] or 0), r["text"]) for r in bpe.decode_documents(encoded, PATH).collect())
    assert back == sorted(((i or 0), t or "") for i, t in data.TEXTS)
    assert bpe.encode_documents(data.empty(spark), PATH).count() == 0


def test_digests(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in bpe.encode_documents(docs, PATH, digests=True).collect():
        ids = library(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()

"""Documents with everything that may be odd about them."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside.
        *[T.StructField(n, T.StringType()) for n in ("text_hash", "kept", "key", "digest", "node", "set_id", "cell", "h", "id", "line")],
    ]
)
LONG = " ".join(f"wörd{i % 977}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today."),
    (2, "The quick brown  fox jumps over the lazy dog near the old river bank today.\n"),
    (3, None),
    (4, ""),
    (5, " \t\n\x0b\x0c\r "),
    (6, LONG),
    (6, LONG),
    (7, LONG + " end"),
    (None, "a text without an id"),
    (None, None),
    (8, "two words"),
    (8, "another text under the same id"),
    (9, "x" * 50_000),
    (10, "é ü 中文 𝄞 mixed <|endoftext|> text"),
    (11, "Two  Words"),
]


def rows(texts=TEXTS):
    return [(i, t, None if i is None else "en", None, None, *["extra"] * 10) for i, t in texts]


def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(spark, texts):
    return spark.createDataFrame(list(texts), "doc_id long, text string")

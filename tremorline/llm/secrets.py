"""Secrets: patterns, and strings that look drawn at random. DataFrame operations only.

Two Markov models over characters are counted from labelled samples: the values that the patterns find are random strings,
what other long words the documents hold are ordinary identifiers. A word is reported if the log-likelihood ratio of
the two models, per step from one character to the next, reaches ``THRESHOLD``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import stored, text_of
from tremorline.llm.spans import digest, places, written

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LONGEST_WORD = r"[A-Za-z0-9+/_=-]{16,}"
SAMPLE_WORD = r"[A-Za-z0-9+/_=-]{6,}"
#: Ordinary identifiers are counted in about so many documents, and random strings in so many that hold one.
SAMPLE_DOCS = 4_000
SAMPLE_RANDOM = 40_000
SMOOTHING = 0.5
LEANING = 4.0
#: Nats per step.
THRESHOLD = 0.8

PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
}
#: The group of each pattern that holds the secret itself, and the least length of an assigned one.
GROUPS = {"assign": 1, "access": 0, "hex": 0}
ASSIGNED = 12
KINDS = [*PATTERNS, "markov"]


def _sorted_name(kind: str) -> str:
    """Kinds sort as they are listed."""
    return f"{KINDS.index(kind)}{kind}"


def _valid(kind: str, match: Column) -> Column:
    if kind != "assign":
        return F.lit(True)
    return F.length(F.regexp_extract(match, PATTERNS[kind], 1)) >= ASSIGNED


def _steps(words: DataFrame) -> dict[str, int]:
    """How often one character follows another in the words; at most the square of the alphabet comes back."""
    letters = F.split("word", "")
    pairs = F.zip_with(letters, F.slice(letters, 2, F.length("word")), lambda a, b: F.concat(a, b))
    counted = words.where(F.length("word") >= 2).select(F.explode(pairs).alias("pair")).groupBy("pair").count()
    return {r["pair"]: r["count"] for r in counted.where(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$")).collect()}


def learn(docs: DataFrame) -> list[float]:
    """The log-likelihood ratio of each step, random against ordinary, row by row of the alphabet."""
    text = text_of(docs)
    place = F.pmod(F.xxhash64(text), F.lit(1 << 30)) / (1 << 30)
    rows = docs.select(text.alias("text"), place.alias("place"))
    values = F.concat(*[F.regexp_extract_all("text", F.lit(p), F.lit(GROUPS[k])) for k, p in PATTERNS.items()])
    values = F.filter(values, lambda x: F.length(x) >= ASSIGNED)
    found = stored(rows.select("place", values.alias("values")).where(F.size("values") > 0), "values")
    n_docs, n_found = rows.count(), found.count()
    random = found.where(F.col("place") < SAMPLE_RANDOM / max(1, n_found)).select(F.explode("values").alias("word"))
    plain = F.regexp_replace("text", "|".join(PATTERNS.values()), " ")
    ordinary = rows.where(F.col("place") < SAMPLE_DOCS / max(1, n_docs)).select(
        F.explode(F.regexp_extract_all(plain, F.lit(SAMPLE_WORD), F.lit(0))).alias("word")
    )
    return ratios(_steps(random), _steps(ordinary))


def steps_to_chances(counts: dict[str, int]) -> list[list[float]]:
    """For each character how likely each other one follows; little seen ones lean on how frequent characters are."""
    ends = {b: sum(counts.get(a + b, 0) for a in ALPHABET) + SMOOTHING for b in ALPHABET}
    total = sum(ends.values())
    rows = []
    for a in ALPHABET:
        seen = sum(counts.get(a + b, 0) for b in ALPHABET)
        rows.append([(counts.get(a + b, 0) + LEANING * ends[b] / total) / (seen + LEANING) for b in ALPHABET])
    return rows


def ratios(random: dict[str, int], ordinary: dict[str, int]) -> list[float]:
    pairs = zip(steps_to_chances(random), steps_to_chances(ordinary), strict=True)
    return [math.log(x / y) for one, other in pairs for x, y in zip(one, other, strict=True)]


def looks_random(word: Column, table: list[float], threshold: float = THRESHOLD) -> Column:
    """Whether the mean ratio over the steps of a word reaches the threshold."""
    ratio = F.split(F.lit(",".join(f"{x:.5f}" for x in table)), ",").cast("array<double>")
    codes = F.split(F.lit(",".join(str(max(0, ALPHABET.find(chr(i)))) for i in range(128))), ",").cast("array<int>")
    places_ = F.transform(F.split(word, ""), lambda c: F.get(codes, F.ascii(c)))
    steps = F.zip_with(places_, F.slice(places_, 2, F.length(word)), lambda a, b: F.get(ratio, a * len(ALPHABET) + b))
    total = F.aggregate(steps, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    return total >= threshold * (F.length(word) - 1)


def scan(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    """One row per document: doc_id, spans of each kind, and all of them by start, then kind, in code points.

    Spans of the model (``markov``) are whole words that meet no span of a pattern. A null text is an empty one and holds
    nothing; repeated rows get the same spans. Without samples both models are flat and report nothing. Reads doc_id
    and text only. An empty table gives no rows.
    """
    table = table or learn(docs)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    words = {**PATTERNS, "markov": LONGEST_WORD}
    hits = rows.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in words.items()])

    def valid(kind: str, match: Column) -> Column:
        return looks_random(match, table) if kind == "markov" else _valid(kind, match)

    spans = hits.select(
        "doc_id",
        *[places(F.col("text"), p, _sorted_name(k), F.col(f"m_{k}"), lambda m, k=k: valid(k, m)).alias(k) for k, p in words.items()],
    ).withColumn("base", F.array_sort(F.concat(*PATTERNS)))
    apart = F.filter(
        "markov", lambda m: ~F.exists("base", lambda b: (m["start"] < b["end"]) & (b["start"] < m["end"]))
    )
    spans = spans.withColumn("markov", apart).withColumn("every", F.array_sort(F.concat("base", "markov")))

    def named(spans: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(x["start"], F.substring(x["kind"], 2, 20).alias("kind"), x["end"]))

    return spans.select("doc_id", *PATTERNS, "markov", named(F.col("base")).alias("base"), named(F.col("every")).alias("every"))


def report(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in PATTERNS],
        digest(F.col("base")).alias("base_sha256"),
        written(F.col("every")).alias("spans"),
        F.size("markov").cast("bigint").alias("n_markov"),
    )

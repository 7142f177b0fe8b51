"""Personal data: patterns, and terms that the corpus shows to give it away. DataFrame operations only.

Patterns find e-mail addresses, IP addresses, payment cards and phone numbers. Each distinct value is a protected
entity e. A term t near an occurrence of e discloses it as far as knowing t tells about e:

    PMI(e; t) = log2(n(e, t) * N / (n(e) * n(t)))    against    IC(e) = log2(N / n(e)),

with N the number of documents, n(e) and n(t) of those that hold e and t, n(e, t) of those with t near e. A term that
stands nowhere else has PMI = IC: it identifies e as well as e itself. Terms with PMI of at least ``DISCLOSURE`` * IC
are generalised like the entity wherever that document uses them, however few documents hold the entity: what guards
against noise is how rare the term is. Near an entity of one document only terms of at most N ** (1 - ``DISCLOSURE``)
documents pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import stored, text_of
from tremorline.llm.spans import digest, places, written

#: Code points on each side of an entity in which terms count as near it.
REACH = 100
DISCLOSURE = 0.8
TERM = r"\p{L}{3,}"
TERMS_TO_SEND = 1_000_000

#: A match begins where a run of its first characters does, or where the match before it ends: so each run is read once.
#: Possessive quantifiers change no match here, and need no stack for long ones.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold to be searched at all.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
KINDS = list(PATTERNS)


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right: every second digit from the right counts double, less nine above nine."""
    def add(state: Column, digit: Column) -> Column:
        value = digit.cast("int") * F.when(state["odd"], 1).otherwise(2)
        return F.struct((~state["odd"]).alias("odd"), (state["sum"] + value - F.when(value > 9, 9).otherwise(0)).alias("sum"))

    start = F.struct(F.lit(True).alias("odd"), F.lit(0).alias("sum"))
    return F.aggregate(F.split(F.reverse(digits), ""), start, add, lambda state: state["sum"] % 10 == 0)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def find_entities(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_hash, an array of spans for each kind, and the text if any is not empty."""
    text = text_of(docs)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    none = F.array().cast("array<string>")
    hits = rows.select(
        "*",
        *[
            F.when(F.contains("text", F.lit(NEEDS[k])), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none).alias(f"m_{k}")
            for k, p in PATTERNS.items()
        ],
    )
    spans = hits.select(
        "doc_id", "text_hash", "text",
        *[places(F.col("text"), p, k, F.col(f"m_{k}"), lambda m, k=k: _valid(k, m)).alias(k) for k, p in PATTERNS.items()],
    )
    some = F.greatest(*[F.size(k) for k in KINDS]) > 0
    return spans.select("doc_id", "text_hash", F.when(some, F.col("text")).alias("text"), *KINDS)


def _near(span: Column, text: Column) -> Column:
    """The distinct terms on both sides of a span; words cut by the reach do not count."""
    left = F.substring(text, F.greatest(span["start"] - REACH, F.lit(0)) + 1, F.least(span["start"], F.lit(REACH)))
    right = F.substring(text, span["end"] + 1, F.lit(REACH))
    left = F.when(span["start"] > REACH, F.regexp_replace(left, r"^\p{L}+", "")).otherwise(left)
    right = F.when(F.length(right) == REACH, F.regexp_replace(right, r"\p{L}+$", "")).otherwise(right)
    return F.array_distinct(F.regexp_extract_all(F.lower(F.concat(left, F.lit(" "), right)), F.lit(TERM), F.lit(0)))


def _entity(span: Column, text: Column) -> Column:
    value = F.lower(F.substring(text, span["start"] + 1, span["end"] - span["start"]))
    plain = F.when(span["kind"].isin("card", "phone"), F.regexp_replace(value, "[^0-9]", "")).otherwise(value)
    return F.hex(F.xxhash64(span["kind"], plain))


def disclosing_terms(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pair, disclosure) of entities and terms that give them away; (doc_id, text_hash, pair) of all pairs in documents.

    ``pair`` is the entity's hash, a space and the term.
    """
    spans = F.concat(*KINDS)
    held = found.where("text IS NOT NULL").select("doc_id", "text_hash", "text", spans.alias("spans"))
    near = F.flatten(
        F.transform("spans", lambda s: F.transform(_near(s, F.col("text")), lambda t: F.concat(_entity(s, F.col("text")), F.lit(" "), t)))
    )
    pairs = stored(held.select("doc_id", "text_hash", F.explode(F.array_distinct(near)).alias("pair")), "pairs")
    entities = held.select(F.explode(F.array_distinct(F.transform("spans", lambda s: _entity(s, F.col("text"))))).alias("entity"))
    n_entity = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    together = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n_et"))
    together = stored(
        together.select("pair", "n_et", F.substring_index("pair", " ", 1).alias("entity"), F.substring_index("pair", " ", -1).alias("term")),
        "together",
    )
    terms = together.select("term").distinct()
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text_of(docs)), F.lit(TERM), F.lit(0)))).alias("term"))
    # Beyond the bound all words are counted in the map tasks; the join with the pairs leaves those that are asked for.
    if terms.count() <= TERMS_TO_SEND:
        words = words.join(F.broadcast(terms), "term", "left_semi")
    n_term = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    n = found.count()
    pmi = F.log2(F.col("n_et") * n / (F.col("n_e") * F.col("n_t")))
    content = F.log2(F.lit(n) / F.col("n_e"))
    scored = together.join(n_term, "term").join(n_entity, "entity").select(
        "pair", F.when(content > 0, F.least(pmi / content, F.lit(1.0))).otherwise(F.lit(0.0)).alias("disclosure")
    )
    return scored.where(F.col("disclosure") >= DISCLOSURE), pairs


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_hash, spans of each kind (``term`` for disclosing terms), in code points.

    A null text is an empty one and holds nothing. Rows that agree in id and text get the same spans. Reads doc_id and text
    only. An empty table gives no rows.
    """
    found = stored(find_entities(docs), "entities")
    flagged, pairs = disclosing_terms(docs, found)
    listed = (
        pairs.join(flagged.select("pair"), "pair")
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set(F.substring_index("pair", " ", -1))).alias("terms"))
        .withColumnsRenamed({"doc_id": "id", "text_hash": "hash"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    texts = found.where("text IS NOT NULL").select("doc_id", "text_hash", "text").dropDuplicates(["doc_id", "text_hash"])
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    hits = texts.join(listed, same).select("id", "hash", "text", pattern.alias("pattern"))
    hits = hits.select("*", F.regexp_extract_all("text", F.col("pattern"), F.lit(0)).alias("matches"))
    extra = hits.select(
        "id", "hash", places(F.col("text"), F.col("pattern"), "term", F.col("matches"), lambda _: F.lit(True)).alias("term")
    )
    joined = found.drop("text").join(extra, same, "left").drop("id", "hash")
    nothing = F.array().cast("array<struct<start:int,kind:string,end:int>>")
    return joined.withColumn("term", F.coalesce("term", nothing))


def report(found: DataFrame) -> DataFrame:
    """Counts, digest of the pattern spans, and all spans as text."""
    base, every = F.concat(*KINDS), F.concat(*KINDS, "term")
    return found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        digest(base).alias("base_sha256"),
        written(every).alias("spans"),
        F.size("term").cast("bigint").alias("n_term"),
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id and the text with entities generalised to their kind and disclosing terms removed; see above."""
    found = find_personal_data(docs).dropDuplicates(["doc_id", "text_hash"])
    marks = found.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.array_sort(F.concat(*KINDS, "term")).alias("spans"))
    text = text_of(docs)
    same = docs["doc_id"].cast("bigint").eqNullSafe(marks["id"]) & (F.xxhash64(text) == marks["hash"])
    rows = docs.join(marks, same).select(docs["doc_id"], text.alias("text"), "spans")

    def cover(state: Column, s: Column) -> Column:
        label = F.when(s["kind"] == "term", F.lit("")).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
        kept = F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"])
        fits = s["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fits, F.concat(state["out"], kept, label)).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        "spans", start, cover, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text")))
    )
    return rows.select("doc_id", clean.alias("text"))

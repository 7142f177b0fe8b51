from collections import defaultdict

from tests.llm import data
from tremorline.llm import line_dedup
from tremorline.llm.line_dedup import drop_lines, parse


def expected(rows, min_docs=5, stable=0.7):
    leaves, places = defaultdict(set), defaultdict(set)
    lines = [(r, n, *parse(line)) for r, (_, t) in enumerate(rows) for n, line in enumerate((t or "").encode().split(b"\n"))]
    lines = [x for x in lines if x[3]]
    for r, _, leaf, tokens in lines:
        leaves[leaf].add(r)
        for i, t in enumerate(tokens):
            places[leaf, i, t].add(r)
    templates = defaultdict(list)
    for r, n, leaf, tokens in lines:
        constant = tuple((i, t) for i, t in enumerate(tokens) if len(places[leaf, i, t]) >= min_docs)
        if len(leaves[leaf]) >= min_docs and len(constant) >= stable * len(tokens):
            templates[leaf, constant].append((r, n))
    gone = defaultdict(set)
    for members in templates.values():
        if len({r for r, _ in members}) >= min_docs:
            for r, n in sorted(members, key=lambda m: (rows[m[0]][0], m[1]))[1:]:
                gone[r].add(n)
    return sorted(
        (d, "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in gone[r])) for r, (d, t) in enumerate(rows)
    )


def test_against_a_plain_version(spark, sf_dir, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = expected(rows)
    assert sum(len(t) for _, t in want) < sum(len(t) for _, t in rows)
    assert sorted((r["doc_id"], r["text"]) for r in drop_lines(data.plain(spark, rows)).collect()) == want
    monkeypatch.setattr(line_dedup, "LEAVES_TO_SEND", 0)
    assert sorted((r["doc_id"], r["text"]) for r in drop_lines(data.plain(spark, rows)).collect()) == want


def test_fields_vary_and_prose_stays(spark):
    rows = [(i, f"Copyright {1990 + i} by the Acme company, all rights reserved\nThe only {'abcdefgh'[i] * 5} line of its kind\n\n") for i in range(8)]
    got = {r["doc_id"]: r for r in drop_lines(data.plain(spark, rows)).collect()}
    assert got[0]["n_dropped"] == 0 and got[0]["text"] == rows[0][1]
    assert all(got[i]["n_dropped"] == 1 and got[i]["text"] == rows[i][1].split("\n", 1)[1] for i in range(1, 8))


def test_odd_rows(spark):
    got = drop_lines(data.odd(spark)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted((i or 0, t or "") for i, t in data.TEXTS)
    assert drop_lines(data.empty(spark)).count() == 0

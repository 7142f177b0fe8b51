import random
from collections import defaultdict

import pytest

from tests.llm import data
from tremorline.llm import near_dedup
from tremorline.llm.components import components
from tremorline.llm.near_dedup import drop_near_copies, near_groups


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows, percent=85):
    sets, owners, parents = [shingles(t) for _, t in rows], defaultdict(list), list(range(len(rows)))

    def find(i):
        while parents[i] != i:
            i = parents[i]
        return i

    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in owners[x]:
                common[j] += 1
            owners[x].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parents[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def found(frame, **options):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_groups(frame, **options).collect())


def test_against_all_pairs(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert found(data.plain(spark, rows)) == expected(rows)


@pytest.mark.parametrize("edits", [1, 3])
def test_large_groups_in_blocks(spark, monkeypatch, edits):
    """Copies of one text: with one edit they are linked among themselves, with three only some of them are."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "SMALL", 8)
    rnd = random.Random(edits)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rnd.sample(range(len(words)), edits):
            words[at] = f"e{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"z{rnd.randint(0, 10**6)}" for _ in range(30))) for i in range(20)]
    assert found(data.plain(spark, rows)) == expected(rows)


def test_odd_rows(spark):
    got = near_groups(data.odd(spark)).collect()
    assert len(got) == len(data.TEXTS)
    labels = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got}
    assert labels[(2, 11)] == labels[(1, 11)] == 1
    assert labels[(3, 0)] == 3 and labels[(4, 0)] == 4 and labels[(None, 0)] is None
    assert labels[(11, 1)] == labels[(8, 1)] == 8
    assert labels[(7, len(shingles(data.LONG + " end")))] == 6
    assert near_groups(data.empty(spark)).count() == 0


def test_stage_keeps_one_of_each_group(spark):
    left = drop_near_copies(data.odd(spark))
    assert left.columns == data.odd(spark).columns
    ids = sorted((r["doc_id"] or 0) for r in left.collect())
    assert 2 not in ids and 7 not in ids and 11 not in ids
    assert {1, 3, 4, 5, 6, 9, 10} <= set(ids) and ids.count(0) == 2


def test_stage_keeps_groups_that_share_an_id(spark):
    """Unrelated texts under one id, or without an id, are groups of their own; a near copy of one of them goes."""
    rnd = random.Random(9)
    one, other, *loose = (" ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(80)) for _ in range(6))
    rows = [(5, one), (5, other), (9, f"{other} end"), *((None, t) for t in loose), (None, f"{loose[0]} end")]
    left = {(r["doc_id"], r["text"]) for r in drop_near_copies(data.plain(spark, rows)).collect()}
    assert {(5, one), (5, other), *((None, t) for t in loose[1:])} <= left
    assert left - set(rows[:2]) - {(None, t) for t in loose[1:]} in ({(None, loose[0])}, {(None, f"{loose[0]} end")})
    kept = [(r["doc_id"], r["text"]) for r in drop_near_copies(data.odd(spark)).collect()]
    assert {(8, "two words"), (8, "another text under the same id")} <= set(kept)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_rows_under_one_id_meet_their_own_sets_only(spark):
    rnd = random.Random(12)
    texts = [" ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(40)) for _ in range(150)]
    rows = [(4, t) for t in texts for _ in range(2)] + [(4, f"{t} end") for t in texts] + [(None, f"{t} so") for t in texts[:50]]
    got = near_groups(data.plain(spark, rows)).collect()
    assert len(got) == len(rows) and {r["component_id"] for r in got} == {4}
    assert {r["n_shingles"] for r in got} == {36, 37}


def test_recall_in_crowded_nodes(spark):
    """Documents that share a passage, 70 % alike, below the threshold: pairs just above it are still found."""
    rnd = random.Random(5)
    passage = [f"p{i}" for i in range(130)]
    own = [[f"w{rnd.randint(0, 10**9)}" for _ in range(27)] for _ in range(1200)]
    rows = [(i, " ".join(passage + words)) for i, words in enumerate(own)]
    more = [(10_000 + i, " ".join(passage + own[i] + [f"x{rnd.randint(0, 10**9)}" for _ in range(26)])) for i in range(400)]
    labels = {d: c for d, _, c in found(data.plain(spark, rows + more))}
    assert all(labels[i] == i for i in range(1200)), "clean documents are not linked"
    met = sum(labels[10_000 + i] == i for i in range(400))
    print(f"met {met} of 400")
    assert met >= 396

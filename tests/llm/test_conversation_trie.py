import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tremorline.llm import conversation_trie
from tremorline.llm.conversation_trie import Parens, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, id string, path string, depth string, n string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """The definition, with tuples of turns as nodes."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(turns, key=lambda x: x[:2])] for c, turns in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (c % 5 if c >= 0 else -(-c % 5))
        path = tuple(own.get(donor, [])[:h] + turns[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (min(convs), len(node), min(members[node[:-1]]) if node else -1, len(convs), len(children[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
        for node, convs in members.items()
    )


def found(frame):
    got = [tuple(r) for r in prefix_trie(frame).select(*COLUMNS).collect()]
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in got)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "n") for r in rows], SCHEMA)


@pytest.fixture(params=[(30_000, 1024, 4096), (40, 1024, 3), (25, 3, 2)], ids=["one shard", "many shards", "bands"])
def limits(request, monkeypatch):
    for name, value in zip(("SHARD", "BAND", "IDS"), request.param, strict=True):
        monkeypatch.setattr(conversation_trie, name, value)


def test_parentheses_close():
    rnd = random.Random(1)
    for n in (1, 2, 5, 100, 3000):
        bits, stack, closes = [], [], {}
        while len(bits) < 2 * n:
            opened = len(closes) + len(stack)
            if stack and (opened == n or rnd.random() < 0.45):
                closes[stack.pop()] = len(bits)
                bits.append(0)
            else:
                stack.append(len(bits))
                bits.append(1)
        opens = np.array(sorted(closes))
        assert Parens(np.array(bits, np.uint8)).findclose(opens).tolist() == [closes[i] for i in opens.tolist()]
    deep = np.array([1] * 5000 + [0] * 5000, np.uint8)
    assert Parens(deep).findclose(np.arange(5000)).tolist() == list(range(9999, 4999, -1))


def test_against_the_definition(spark, sf_dir, limits):
    frame = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert found(frame) == plain([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])


def test_sql_says_the_same():
    db = duckdb.connect()
    db.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.01/conversations.parquet'")
    rows = db.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    got = db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({conversation_trie.SQL})").fetchall()
    assert sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in got) == plain(rows)


def test_copies_and_shared_beginnings(spark, limits):
    """A hot first turn, many equal conversations, prefixes of one another, some long ones and ones without turns."""
    rnd = random.Random(5)
    rows = []
    for c in range(0, 240):
        turns = [("user", "hello"), ("assistant", "hi")] if c % 3 else []
        turns += [("user", f"q{rnd.randint(0, 3)}") for _ in range(rnd.randint(0 if turns else 1, 12))]
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    rows += [(1000 + c, k, "user", f"é{k}") for c in range(30) for k in range(4 + c % 2 * 16)]
    # The donor is missing, and all own turns are among the first: no turn is left.
    rows += [(c, 0, "user", "alone") for c in range(2001, 2040) if c % 5]
    assert found(table(spark, rows)) == plain(rows)


def test_odd_rows(spark, limits):
    rows = [(5, None, None, None), (5, 1, "user", None), (5, 2, None, "text"), (6, 3, "user", "text"), (6, 3, "user", "text"),
            (-3, 0, "a", "b"), (-5, 0, "a", "c"), (0, 1, "", "x"), (None, 1, "user", "nobody"), (None, None, None, None),
            (7, 0, "user", "wörd " * 20_000), (8, 0, "us", "er:1"), (9, 0, "use", "r:1"), (10**15, 1, "user", "large id")]
    assert found(table(spark, rows)) == plain(rows)
    assert prefix_trie(table(spark, [(None, 1, "a", "b")])).collect() == []
    assert prefix_trie(table(spark, [])).collect() == []


def test_ids_are_hashed_in_pieces(monkeypatch):
    """Lists cut into pieces, over several batches, have the hash of the whole."""
    monkeypatch.setattr(conversation_trie, "IDS", 3)
    rows = sorted((bytes([k % 4]) * 16, k * 7) for k in range(50))

    def batches(columns, rows, types, size=7):
        for at in range(0, len(rows), size):
            part = list(zip(*rows[at : at + size], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, types, strict=True)], names=columns)

    pieces = [r for b in conversation_trie._join_ids(batches(["tip", "conv_id"], rows, [pa.binary(), pa.int64()])) for r in b.to_pylist()]
    assert max(p["ids"].count(",") for p in pieces) == 2
    again = batches(["tip", "first", "ids"], [(p["tip"], p["first"], p["ids"]) for p in pieces], [pa.binary(), pa.int64(), pa.string()])
    got = {r["tip"]: r["ends_sha256"] for b in conversation_trie._hash_ids(again) for r in b.to_pylist()}
    assert got == {bytes([k]) * 16: hashlib.sha256(",".join(str(i) for t, i in rows if t[0] == k).encode()).hexdigest() for k in range(4)}

import hashlib
import random
import re

import numpy as np
import pytest

from tests.llm import data
from tremorline.llm.exact_dedup import drop_copies, exact_groups, grow_directory


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        text = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), doc_id is None, doc_id))
    return {n: (min(g, key=lambda x: x[:2] + ((x[2],) if x[2] is not None else (0,)))[2], len(g)) for n, g in groups.items()}


def check(frame, rows, **options):
    want = expected(rows)
    got = exact_groups(frame, **options).collect()
    assert len(got) == len(rows)
    by_digest = {hashlib.sha256(n.encode()).hexdigest(): v for n, v in want.items()}
    for r in got:
        assert (r["keep_id"], r["group_size"]) == by_digest[r["text_sha256"]]
    assert sum(r["kept"] for r in got) == len(want)
    return got


def test_odd_rows(spark):
    check(data.odd(spark), data.TEXTS)


def test_empty_table(spark):
    assert exact_groups(data.empty(spark)).count() == 0
    assert drop_copies(data.empty(spark)).count() == 0


@pytest.mark.parametrize("options", [{}, {"key_bits": 3}, {"key_bits": 5, "seen_bytes": 50, "bucket_bytes": 40}])
def test_collisions_are_chained(spark, options):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 4)))) for i in range(600)]
    got = check(data.plain(spark, rows).repartition(5), rows, **options)
    if options:
        assert max(r["slot"] for r in got) > 0


def test_stage_keeps_one_of_each(spark):
    left = drop_copies(data.odd(spark))
    assert left.columns == data.odd(spark).columns
    texts = [re.sub(r"\s", "", r["text"] or "", flags=re.ASCII) for r in left.collect()]
    assert sorted(texts) == sorted(expected(data.TEXTS))


def test_directory_splits_only_large_buckets(spark):
    keys = [(k << 53, 10) for k in range(64)] + [((1 << 62) + i, 10) for i in range(300)]
    starts = grow_directory(spark.createDataFrame(keys, "key long, n_bytes long"), 200)
    held = np.bincount(np.searchsorted(starts, [k for k, _ in keys], side="right") - 1)
    assert held.max() * 10 <= 200
    alike = spark.createDataFrame([(5, 1000)] * 3, "key long, n_bytes long")
    assert len(grow_directory(alike, 100)) < 64

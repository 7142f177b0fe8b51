import glob

from pyspark.sql import functions as F

from tests.llm import data
from tremorline.llm.sharding import shard_documents, write_shards


def loads(frame, limit):
    held = {}
    for r in shard_documents(frame, limit).collect():
        held.setdefault((r["shard"], r["page"]), []).append(r["n_bytes"])
    return held


def test_every_shard_fits_or_holds_one_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = loads(docs, 20_000)
    assert sum(map(len, held.values())) == docs.count()
    assert all(sum(v) <= 20_000 or len(v) == 1 for v in held.values())
    names = sorted(s for s, _ in held if len(s) < 60)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))


def test_one_shard_if_all_fit(spark):
    assert set(loads(data.plain(spark, [(1, "a"), (2, None)]), 100)) == {("root", 0)}


def test_odd_rows(spark):
    held = loads(data.odd(spark), 1_000)
    assert sum(map(len, held.values())) == len(data.TEXTS)
    assert all(sum(v) <= 1_000 or len(v) == 1 for v in held.values())
    assert shard_documents(data.empty(spark)).count() == 0


def test_one_id_and_one_row_many_times(spark):
    held = loads(data.plain(spark, [(7, f"text {i:03d}") for i in range(200)]), 100)
    assert all(sum(v) <= 100 for v in held.values()) and sum(map(len, held.values())) == 200
    held = loads(data.plain(spark, [(None, "x" * 30)] * 50), 100)
    assert sorted(map(len, held.values())) == [2] + [3] * 16


def written(spark, docs, path, limit):
    """Rows read back, and the bytes and rows of each folder; the directory says the same."""
    directory = {(r["shard"], r["page"]): (r["n_docs"], r["n_bytes"] or 0) for r in write_shards(docs, path, limit).collect()}
    back = spark.read.parquet(path)
    shard, page = back.columns[-2:]
    size = F.octet_length(F.coalesce("text", F.lit("")))
    held = {(r[0][1:], r[1]): (r[2], r[3]) for r in back.groupBy(shard, page).agg(F.count(F.lit(1)), F.sum(size)).collect()}
    assert held == directory
    assert all(n == 1 or total <= limit for n, total in held.values())
    key = [c for c in docs.columns]
    assert sorted(map(repr, back.select(*key).collect())) == sorted(map(repr, docs.collect()))
    return held


def test_written_shards_hold_all_rows(spark, tmp_path):
    held = written(spark, data.plain(spark, [(i, "x" * 50) for i in range(40)]), str(tmp_path / "shards"), 400)
    assert len(glob.glob(f"{tmp_path}/shards/_shard=*")) == len(held)


def test_written_shards_of_one_id_and_of_copies_keep_the_limit(spark, tmp_path):
    texts = [(7, f"text {i:03d} " + "x" * 90) for i in range(200)]
    assert len(written(spark, data.plain(spark, texts), str(tmp_path / "texts"), 1_000)) >= 20
    copies = data.plain(spark, [(None, "x" * 30)] * 50 + [(1, "y" * 300)] * 3 + [(2, None)]).repartition(5)
    assert len(written(spark, copies, str(tmp_path / "copies"), 100)) >= 20


def test_written_shards_leave_the_users_columns_alone(spark, tmp_path):
    docs = data.plain(spark, [(i, "x" * 50) for i in range(30)])
    docs = docs.select("*", F.lit("mine").alias("shard"), F.lit(5).alias("page"), F.lit("too").alias("_shard"), F.lit(1).alias("_page"))
    written(spark, docs, str(tmp_path / "shards"), 400)


def test_written_shards_of_odd_rows_and_of_none(spark, tmp_path):
    odd = data.odd(spark)
    written(spark, odd.select("doc_id", "text"), str(tmp_path / "odd"), 1_000)
    assert write_shards(data.empty(spark), str(tmp_path / "none")).count() == 0

import re

import corpus_pipeline
from tests.llm import data
from tests.llm.test_near_dedup import expected as near_expected
from tremorline.llm import bpe, quality
from tremorline.llm.common import stored
from tremorline.llm.decontaminate import plain


def test_whole_pipeline_against_a_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = quality.rate_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("kept")
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    rows = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in ids}
    groups = {}
    for i, t in rows.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i))
    rows = {i: rows[i] for i in (min(g)[1] for g in groups.values())}
    rows = {i: rows[i] for i, _, least in near_expected(list(rows.items()), 80) if i == least}
    items = [plain(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = {i: t for i, t in rows.items() if not any(item in plain(t) for item in items)}
    got = corpus_pipeline.run(spark, sf_dir)
    words = bpe.vocabulary(bpe.vocabulary_path())
    assert {r["doc_id"]: words.decode(r["ids"]).decode() for r in got.collect()} == rows


def test_every_stage_takes_odd_rows(spark, sf_dir):
    for docs in (data.odd(spark), data.empty(spark)):
        columns, n = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, data.odd(spark).limit(n), sf_dir).count() <= n
            out = stage(spark, docs, sf_dir)
            if name != "tokens":
                assert out.columns == columns
                docs = stored(out, name)
        assert out.count() == docs.count()

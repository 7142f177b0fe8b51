import duckdb
import glob
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from catalog.oracles import all_oracles
from catalog.queries import all_queries

WRITES_MANY_FILES = {"backlog_view", "lake_roundtrip", "pruned_read", "lake_listing", "stream_sync", "publish_twice",
                     "sync_redelivered"}
QUICK = sorted(set(all_queries()) - WRITES_MANY_FILES)


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.count() == 56
    assert frame.where("anomaly_detected and ground_truth").count() == 1


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("also", [[], ["corpus_pipeline.py"]])
def test_the_corpus_queries_may_be_left_out(tmp_path, also):
    """The repository without the two folders, and without the pipeline beside them, still has all other queries."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *also))
    assert (copy / "corpus_pipeline.py").exists() == (not also and os.path.exists(f"{root}/corpus_pipeline.py"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.stdout.split() == [str(len(all_queries()))] * 2, done.stderr


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, db, sf_dir, name):
    frame = entry.queries()[name](spark, sf_dir)
    cursor = db.execute(entry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    assert table(frame.columns, [tuple(r) for r in frame.collect()]) == table(names, cursor.fetchall())

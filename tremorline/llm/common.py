"""What the corpus operators share: tables, stored intermediate results, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.session import new_folder

#: The white space that every operator here knows: space, tab, line feed, vertical tab, form feed, return.
BLANKS = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: no later job repeats it, no lost executor takes it."""
    path = new_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(df: DataFrame) -> Column:
    """The text, empty if null."""
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def keep_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``decisions`` (doc_id, may be null, and text_hash), columns unchanged.

    The hash of the text tells rows apart that share an id; rows that share both stay or go together.
    """
    key = unused("text_hash", docs)
    wanted = decisions.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    marked = docs.withColumn(key, F.xxhash64(text_of(docs)))
    same = marked["doc_id"].cast("bigint").eqNullSafe(wanted["kept_id"]) & (marked[key] == wanted["kept_hash"])
    return marked.join(wanted, same, "left_semi").drop(key)

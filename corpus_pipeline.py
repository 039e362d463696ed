"""A training-data pipeline over ``documents``: each stage calls one operator of ``tidemark.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and
returns the columns of ``documents``; only the last returns pieces of packed sequences.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import packing, quality_rules, secrets, simhash, suffix_dedup as suffix_array
from tidemark.session import checkpoint_dir, ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: also those with a null or empty text. Repeated rows are
    judged one by one; an empty table stays empty."""
    return quality_rules.keep(docs).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component stays, and of equal rows one.

    Rows without an id cannot be named by a component; they stay.
    """
    found = simhash.near_duplicates(docs, shingle=3, limit=2)
    lost = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_lost")).distinct()
    left = docs.join(lost, F.col("doc_id") == F.col("_lost"), "left_anti").withColumn("_same", F.md5("text"))
    return left.dropDuplicates(["doc_id", "_same"]).select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes stay where they start first; a document with nothing left goes."""
    left = suffix_array.without_repeats(docs, length=100).where("kept <> '' or n_removed = 0")
    # A text that loses nothing stays as it is, null or not.
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    return _with_text(left, text)


def _with_text(rows: DataFrame, text: Column) -> DataFrame:
    """The documents in ``row`` with a new text, and its length where it changed."""
    length = F.when(text.eqNullSafe(F.col("row.text")), F.col("row.n_chars")).otherwise(F.length(text))
    values = {"text": text, "n_chars": length.cast("long")}
    return rows.select(*[values.get(c, F.col(f"row.{c}")).alias(c) for c in COLUMNS])


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is masked. Null and empty texts stay as they are, repeated rows get the same mask, an
    empty table stays empty."""
    row = F.struct(*[docs[c] for c in COLUMNS]).alias("row")
    return _with_text(secrets.masked(docs.select(row, docs["text"].alias("text"))), F.col("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4,096 ids, by piece. A null or empty text is its end id alone; repeated rows are packed one
    by one; an empty table gives no piece."""
    return packing.pack(docs, packing.Packing(public_tokenizers.path("word_bpe_49k.json")))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("secret_scans", secret_scan),
    ("cost_packing", pack),
]

#: The stages hash, tokenize and sort suffixes, which SQL cannot express; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    ship(spark)
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{k}-{name}")
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

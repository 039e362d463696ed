"""Operator 9 on held-out labels, the pipeline stage by stage, and the queries' columns."""

import importlib
import sys

import numpy as np
import pytest
from llm_rows import ODD
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import cotrain
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_cotrained_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = cotrain.score(docs, labels.where("doc_id % 3 <> 0"))
    held = scored.join(labels.where("doc_id % 3 = 0"), "doc_id").withColumn("right", (F.col("kept") == (F.col("quality") == 1)).cast("int"))
    assert held.agg(F.avg("right")).first()[0] > 0.95
    assert held.where("quality = 1 and not kept").count() <= 1


def test_classifier_without_labels_and_rows(spark, make):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert cotrain.score(make(ODD), labels).count() == len(ODD)
    assert cotrain.score(make(ODD), labels.limit(0)).select("score").distinct().count() == 1
    assert cotrain.score(make(ODD).limit(0), labels).count() == 0


def test_all_unlabelled_documents_are_scored_for_training(spark, make):
    """More documents than any sample: the pool has each id once, and its sums are those of all rows."""
    rows = [(k, f"Some text {k % 50}. It has words.") for k in range(7000)] + [(1, "Again another text.")] * 500
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)] + [(1, 1, 0)], "doc_id long, quality int, toxic int")
    views, y, pool = cotrain._sample(cotrain.texts(make(rows), "lang", "source", "n_chars"), labels, cotrain.Plan())
    assert len(y) == len(views[0]) == len(views[1]) == 40
    assert pool.count() == pool.select("doc_id").distinct().count() == 7000 - 40
    w = np.linspace(-1, 1, views[1].shape[1] + 1)
    got = cotrain._total(pool, lambda v: cotrain.sums(v[1], np.ones(len(v[1])), w), 1 + len(w) + len(w) ** 2)
    x = np.array([cotrain.page(t, "en", "s", len(t)) for k, t in rows[40:7000]], "f4").astype(float)
    assert got[0] == 7000 - 40 and np.allclose(got, cotrain.sums(x, np.ones(len(x)), w))


def test_tails_cut_the_share_asked_for():
    odds = np.random.default_rng(3).normal(0, 8, 100_000).clip(-30, 30)
    low, high = cotrain._tails(np.bincount(cotrain._places(odds), minlength=6001), 5000, 0.95)
    assert abs((odds <= low).sum() - 5000) < 50 and abs((odds >= high).sum() - 5000) < 50
    assert cotrain._tails(np.bincount(cotrain._places(odds / 100), minlength=6001), 5000, 0.95) == pytest.approx((-np.log(19), np.log(19)))


def test_stages(spark, make, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "suffix_array_dedup", "secret_scans", "cost_packing"]
    base = spark.read.parquet(f"{SF}/documents.parquet")
    docs = base.unionByName(make(ODD).select(base.columns))
    sizes = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(path := str(tmp_path / name))
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        if k < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            assert docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").count() == 0 or k == 0
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4]


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_an_empty_table(spark, stage):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert stage(spark, empty, SF).count() == 0


def test_a_clean_document_passes_all_stages(spark, make):
    """Text without faults reaches packing as it was."""
    base = spark.read.parquet(f"{SF}/documents.parquet")
    clean = base.where("doc_id = 1")
    for _, stage in corpus_pipeline.STAGES[:4]:
        clean = stage(spark, clean, SF)
    assert clean.collect() == base.where("doc_id = 1").collect()


def test_queries_are_registered(spark):
    sys.path.insert(0, corpus_pipeline.__file__.rsplit("/", 1)[0])
    entry = importlib.import_module("__spark_entry__")
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())

"""Ranked search against a scan of all documents, and the bounds of the ball tree."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_rows import ODD
from test_dedup import given

from tidemark.llm import ranked_search
from tidemark.llm.ball_tree import LEAF, BallTree
from tidemark.llm.ranked_search import Ranking, best_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def scanned(docs, items, top=50):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, length = len(counted), sum(n for *_, n in counted)
    held = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms(text))
    out = []
    for i, query in wanted.items():
        scores = []
        for d, c, n in counted:
            m = 50 + 50 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in query if t in c)
            if score > 0:
                scores.append((-score, d is not None, d or 0))
        out += [(str(i), k + 1, str(d if some else None), -s) for k, (s, some, d) in enumerate(sorted(scores)[:top])]
    return sorted(out)


def found(df):
    return sorted((str(r["item_id"]), r["rank"], str(r["doc_id"]), r["score"]) for r in df.collect())


def items_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "s") for r in rows], "item_id long, text string, score int, doc_id string")


ITEMS = [(1, "Same line, a WORD é😀 x"), (2, None), (3, ""), (4, "unheard of"), (5, "t1 t2 t3 t50 t96 word"), (5, "minus t4"), (6, "a"), (6, "a"), (None, "x y satz"), (7, "... !!")]


def test_ranks_agree_with_a_scan(spark, make):
    rng = np.random.default_rng(4)
    rows = given(spark, 200) + ODD + [(4000 + k, "copy x y word") for k in range(120)]
    rows += [(5000 + k, " ".join(rng.choice(["t1", "t2", "x", "y", "satz", "word", "Line", "other", "more"], rng.integers(1, 60)))) for k in range(300)]
    items = ITEMS + [(100 + k, t) for k, (_, t) in enumerate(given(spark, 30)) if t]
    got = found(best_documents(make(rows).repartition(3), items_of(spark, items)))
    assert got == scanned(rows, items)


def test_small_trees_and_blocks_of_items(spark, make):
    rows = given(spark, 120) + ODD
    items = ITEMS + [(100 + k, t) for k, (_, t) in enumerate(given(spark, 12)) if t]
    plan = Ranking(top=5, documents=60, entries=3000, pairs=900)
    assert found(best_documents(make(rows).repartition(2), items_of(spark, items), plan)) == scanned(rows, items, 5)


def test_empty_tables(spark, make):
    some = items_of(spark, ITEMS)
    assert best_documents(make(ODD).limit(0), some).count() == 0
    assert best_documents(make(ODD), some.limit(0)).count() == 0
    assert best_documents(make([(1, None), (2, "...")]), some).count() == 0


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "two")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "two")], "item_id string, text string")
    got = [(r["rank"], r["doc_id"]) for r in best_documents(docs, items).orderBy("rank").collect()]
    assert [d for _, d in got][1:] == ["a", "b"] and got[0][1] is None


def sparse(rng, n, size, per_row):
    """Rows in clusters, each with terms of its own."""
    lens = rng.integers(1, per_row, n)
    group = rng.integers(0, 8, n)
    rows = [np.sort(rng.choice(size // 8, k, replace=False)) + g * (size // 8) for k, g in zip(lens, group)]
    return np.concatenate([[0], np.cumsum(lens)]), np.concatenate(rows).astype(np.uint32), rng.integers(1, 10 ** 10, lens.sum())


@pytest.mark.parametrize("seed", range(4))
def test_tree_search_is_exact_and_prunes(seed):
    rng = np.random.default_rng(seed)
    n, size = 3000, 400
    ptr, terms_, values = sparse(rng, n, size, 20)
    tree = BallTree(ptr, terms_, values, size)
    dense = np.zeros((n, size), np.int64)
    dense[np.repeat(np.arange(n), np.diff(ptr)), terms_] = values
    order, wanted = rng.permutation(n), np.zeros(size, np.int64)
    scored = 0
    for _ in range(20):
        query = np.unique(rng.integers(0, size // 8, 6)) + rng.integers(0, 8) * (size // 8)
        scores = dense[:, query].sum(axis=1)
        best = np.lexsort((order, -scores))[:10]
        best = best[scores[best] > 0]
        rows, got, work = tree.top(query, 10, 1, order, wanted)
        assert rows.tolist() == best.tolist() and got.tolist() == scores[best].tolist() and not wanted.any()
        scored += work
        assert tree.top(query, 10, int(scores.max()) + 1, order, wanted)[0].size == 0
    assert scored < 20 * n / 3


def test_radius_covers_every_row():
    rng = np.random.default_rng(9)
    n, size = 500, 64
    ptr, terms_, values = sparse(rng, n, size, 8)
    tree = BallTree(ptr, terms_, values, size)
    dense = np.zeros((n, size))
    dense[np.repeat(np.arange(n), np.diff(ptr)), terms_] = values
    for k in range(len(tree.lo)):
        centre = np.zeros(size)
        centre[tree.centre_terms[k]] = tree.centre_values[k]
        rows = tree.rows[tree.lo[k]:tree.hi[k]]
        assert np.linalg.norm(dense[rows] - centre, axis=1).max() <= tree.radius[k]
        assert (dense[rows][:, tree.centre_terms[k]] <= tree.centre_values[k] + tree.reach[k]).all()
        assert tree.left[k] >= 0 or len(rows) <= LEAF
    same = BallTree(np.arange(0, 2001, 2), np.tile([1, 2], 1000).astype(np.uint32), np.full(2000, 7), 4)  # nothing but copies
    assert len(same.top(np.array([1]), 3, 1, np.arange(1000), np.zeros(4, np.int64))[0]) == 3


def test_weights():
    assert ranked_search.weights(np.array([0, 1, 10]), 10).tolist() == [math.floor(1000 * math.log(x)) for x in (22, 22 / 3, 22 / 21)]

"""The highest-scoring documents for each item of a query set, exactly, by sparse ball trees.

1. Documents become sparse vectors of the terms that items have, in one pass; document frequencies and
   lengths are counted over all documents.
2. With weights known, each task builds ball trees over its documents, some thousand at a time, and
   searches them best-first for each item. What a task has found so far prunes its later trees.
3. The best of each tree meet in one ranking for each item.

Items go in blocks whose terms have a bound, so that each task can hold the vocabulary of a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.ball_tree import BallTree
from tidemark.llm.common import settled, texts

#: Not part of a term: ASCII but letters and digits. A-Z are lower-cased.
_TABLE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_VECTOR = "n long, terms binary, counts binary"


@dataclass(frozen=True)
class Ranking:
    """``top`` documents an item. A tree has up to ``documents`` documents and ``entries`` entries (more only in
    one document); a block of items has about ``pairs`` pairs of item and term, more only in one item."""

    top: int = 50
    documents: int = 8192
    entries: int = 1 << 21
    pairs: int = 1 << 19


def item_terms(items: DataFrame) -> DataFrame:
    """``item`` and ``term``, each pair once. Rows with one id are one item with the terms of all."""
    lowered = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _UPPER, _UPPER.lower())
    return items.select(F.col("item_id").alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(_TERM), F.lit(0))).alias("term")).distinct()


def _counted(rows: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, ``n`` terms with repeats, and the vocabulary's terms with counts, of documents with terms."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for batch in batches:
            total, terms, counts = [], [], []
            for text in batch.column("text"):
                words = text.as_buffer().to_pybytes().translate(_TABLE).split()
                total.append(len(words))
                met, times = np.unique(np.fromiter(filter(None, map(known, words)), np.uint32), return_counts=True)
                terms.append(met.tobytes())
                counts.append(times.tobytes())
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
                ["doc_id", "n", "terms", "counts"])
            yield out.filter(pc.greater(out.column("n"), 0))

    return rows.mapInArrow(run, f"doc_id {id_type}, {_VECTOR}")


def _frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; counted in each task first. As long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(size, np.int64)
        for batch in batches:
            met += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.uint32), minlength=size)
        at = np.nonzero(met)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(met[at])], ["term", "n"])

    out = np.zeros(size, np.int64)
    found = vectors.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return out


def weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequencies.tolist()], np.int64)


def _searched(vectors: DataFrame, queries: list[np.ndarray], weight: np.ndarray, documents: int, length: int, plan: Ranking) -> DataFrame:
    """``query`` (its number), ``doc_id`` and ``score``: of each tree the best that may be among the best of all."""
    id_type = vectors.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(len(weight), np.int64)
        best = [np.zeros(0, np.int64) for _ in queries]  # the scores found so far, which only raise the floor
        held: list[pa.RecordBatch] = []
        size = entries = 0

        def search() -> pa.RecordBatch:
            nonlocal held, size, entries
            rows = pa.Table.from_batches(held).combine_chunks()
            held, size, entries = [], 0, 0
            terms = np.frombuffer(b"".join(rows.column("terms").to_pylist()), np.uint32)
            counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.int64)
            lens = pc.binary_length(rows.column("terms")).to_numpy() // 4
            # Python's whole numbers have no limit.
            m = np.array([50 + 50 * n * documents // length for n in rows.column("n").to_pylist()], np.int64)
            part = 1_000_000_000 * counts // (1000 * counts + 20 * np.repeat(m, lens))
            tree = BallTree(np.concatenate([[0], np.cumsum(lens)]), terms, weight[terms] * part, len(weight))
            order = np.empty(len(rows), np.int64)
            order[pc.sort_indices(rows, sort_keys=[("doc_id", "ascending")], null_placement="at_start").to_numpy()] = np.arange(len(rows))
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for q, query in enumerate(queries):
                floor = int(best[q][-1]) if len(best[q]) == plan.top else 1
                found, scores, _ = tree.top(query, plan.top, floor, order, wanted)
                best[q] = -np.sort(-np.concatenate([best[q], scores]))[:plan.top]
                out.append((np.full(len(found), q), found, scores))
            query, found, scores = (np.concatenate(x) for x in zip(*out))
            ids = rows.column("doc_id").combine_chunks().take(pa.array(found))
            return pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), ids, pa.array(scores)], ["query", "doc_id", "score"])

        for batch in batches:
            batch = batch.filter(pc.greater(pc.binary_length(batch.column("terms")), 0))
            tops = np.cumsum(pc.binary_length(batch.column("terms")).to_numpy() // 4)
            at = 0
            while at < batch.num_rows:
                before = int(tops[at - 1]) if at else 0
                room = int(np.searchsorted(tops, before + plan.entries - entries, side="right")) - at
                take = min(plan.documents - size, batch.num_rows - at, max(room, 0 if size else 1))
                if take:
                    held.append(batch.slice(at, take))
                    size, at = size + take, at + take
                    entries += int(tops[at - 1]) - before
                if at < batch.num_rows:
                    yield search()
        if size:
            yield search()

    return vectors.mapInArrow(run, f"query int, doc_id {id_type}, score long")


def best_documents(docs: DataFrame, items: DataFrame, plan: Ranking = Ranking()) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's ``plan.top`` best documents with a score above 0.

    A null or empty text has no terms: such a document scores nothing and such an item gets no row. Each row
    of ``docs`` is a document, repeated rows too; equal scores go by id, nulls first. Items with one
    id, or with none, are one item. Extra columns are left out. Empty tables give no row.
    """
    spark = docs.sparkSession
    rows = texts(docs)
    terms = settled(item_terms(items))
    item_type, id_type = (x.schema[c].dataType.simpleString() for x, c in ((items, "item_id"), (rows, "doc_id")))
    blocks = -(-terms.count() // plan.pairs)
    out = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    for block in range(blocks):
        mine = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()  # bounded by ``pairs``
        if not mine.num_rows:
            continue
        words = mine.column("term").combine_chunks().dictionary_encode()
        vocabulary = {w.encode(): k + 1 for k, w in enumerate(words.dictionary.to_pylist())}
        vectors = settled(_counted(rows, vocabulary))
        total = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
        if not total["documents"]:
            continue
        weight = weights(_frequencies(vectors, len(vocabulary) + 1), total["documents"])
        names = mine.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
        number, term = names.indices.to_numpy(), words.indices.to_numpy() + 1
        by = np.argsort(number, kind="stable")
        queries = np.split(term[by], np.nonzero(np.diff(number[by]))[0] + 1)
        found = _searched(vectors, queries, weight, total["documents"], total["length"], plan)
        known = spark.createDataFrame([(v, k) for k, v in enumerate(names.dictionary.to_pylist())], f"item_id {item_type}, query int")
        order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= plan.top)
        out = out.unionByName(ranked.join(F.broadcast(known), "query").select("item_id", "rank", "doc_id", "score"))  # as many as the block's items
    return out

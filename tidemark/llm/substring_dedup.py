"""Removal of word passages that occur more than once, by an FM-index per shard.

Shards hold the text around equal anchors (see ``segments``); each builds a compressed FM-index
and streams its texts through it by backward search, so that matching statistics at or above
the threshold report the repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.fm_index import repeated_windows
from tidemark.llm.segments import ROWS, WORDS, Shape, covered, repeats


def without_repeats(docs: DataFrame, length: int = 35, gram: int = 8, dense: int = 20_000) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` and ``kept_sha256`` for each row.

    A word goes when a window of ``length`` words around it also starts anywhere else. Windows
    are judged on the input. Null and empty texts have no words. Equal rows (same id, same text)
    count as one document and each get its result; a null id is an id like any other. Kept
    words are joined by one space.
    """

    def work(texts: list[np.ndarray], windows: np.ndarray, copies: np.ndarray, ranks: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return repeated_windows(texts, length, skip=copies)

    found = repeats(docs, WORDS, Shape(length, gram, dense), work, others_only=False).drop("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            total, removed, kept, digest = [], [], [], []
            lists, tags = batch.column("found"), batch.column("tag").to_pylist()
            for k, text in enumerate(batch.column("text")):
                words = text.as_py().encode().split()
                gone = covered(len(words), lists.slice(k, 1).flatten() if lists[k].is_valid else None, tags[k], length)
                left = b" ".join([w for w, g in zip(words, gone) if not g]) if gone.any() else b" ".join(words)
                total.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(left.decode())
                digest.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(digest, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    id_type = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, kept string, kept_sha256 string")

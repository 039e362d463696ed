"""Removal of byte strings that occurred earlier, by merged suffix orders per shard.

Shards hold the text around equal anchors (see ``segments``). The parts of a shard sort their
own suffixes; their Burrows-Wheeler transforms are merged by interleave refinement, whose
blocks are the repeated intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bwt_merge import repeated_intervals
from tidemark.llm.segments import BYTES, ROWS, Shape, covered, repeats


def later_windows(texts: list[np.ndarray], windows: np.ndarray, ranks: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A bit for each window that also starts earlier, by rank of its document and start there."""
    text, offset, block = repeated_intervals(texts, length)
    first = np.full(int(block.max()) + 1 if len(block) else 0, np.iinfo(np.int64).max)
    when = ranks[text] << 33 | starts[text] + offset
    np.minimum.at(first, block, when)
    late = when != first[block]
    bits = np.zeros(len(texts), np.uint64)
    np.bitwise_or.at(bits, text[late], np.uint64(1) << offset[late].astype(np.uint64))
    return bits


def without_repeats(docs: DataFrame, length: int = 100, gram: int = 40, dense: int = 20_000) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept``, ``kept_sha256`` (of the bytes kept) and ``row``, the input row.

    ``kept`` is text again: bytes at a cut that no longer make a whole character are left out of it.

    A byte goes when a string of ``length`` bytes around it also starts earlier: in a smaller
    id, or earlier in the same document. Strings are judged on the input. Null and empty texts have
    no bytes. Equal rows (same id, same text) count as one document and each get its result;
    different texts under one id are ordered by a hash; a null id is smaller than any other.
    """

    def work(texts: list[np.ndarray], windows: np.ndarray, copies: np.ndarray, ranks: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return later_windows(texts, windows, ranks, starts, length)

    found = repeats(docs, BYTES, Shape(length, gram, dense), work, others_only=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            total, removed, spans, kept, digest = [], [], [], [], []
            lists, tags = batch.column("found"), batch.column("tag").to_pylist()
            for k, text in enumerate(batch.column("text")):
                values = np.frombuffer(text.as_py().encode(), np.uint8)
                gone = covered(len(values), lists.slice(k, 1).flatten() if lists[k].is_valid else None, tags[k], length)
                left = values[~gone].tobytes()
                total.append(len(values))
                removed.append(int(gone.sum()))
                spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                kept.append(left.decode("utf-8", "ignore"))
                digest.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(kept, pa.string()), pa.array(digest, pa.string()), batch.column("row")],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", "row"])

    id_type, row_type = (found.schema[c].dataType.simpleString() for c in ("doc_id", "row"))
    return found.mapInArrow(
        run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept string, kept_sha256 string, row {row_type}")

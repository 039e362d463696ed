"""Cost-balanced packing of documents into sequences of a fixed number of tokens.

A document of n tokens costs ``linear * n + quadratic * n**2``, as attention within it does. The
documents of a block are assigned in descending order to the sequence of lowest cost that has
room for them; what fits nowhere whole is cut and fills the cheapest sequences with room. A
block has just as many sequences as its tokens fill. What is left at the end of a partition
goes to sequences whose lengths are powers of two, which need no padding.

Blocks are formed inside the partitions that the documents come in, so nothing is shuffled and
a task holds one block. Sequence ids are made of partition and position; a partition that is
computed again gives the same ids as long as its rows come in the same order, as they do from files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import texts
from tidemark.llm.wordcodes import kept_codes

_SHORT = [struct.Struct(f"<{n}I") for n in range(1, 17)]


@dataclass(frozen=True)
class Packing:
    """``end`` closes each document; ``block`` is the number of sequences filled together."""

    path: str
    size: int = 4096
    end: int = 2
    linear: float = 1.0
    quadratic: float = 1.0 / 4096
    block: int = 256
    words: int = 1_000_000


@dataclass
class Piece:
    """``length`` ids of a document from ``start``, at ``offset`` of a sequence."""

    doc: int
    start: int
    length: int
    sequence: int
    offset: int


def _packed(ids: Sequence[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return np.array(ids, "<u4").tobytes() if len(ids) > len(_SHORT) else _SHORT[len(ids) - 1].pack(*ids) if ids else b""


def fill(lengths: list[int], capacity: np.ndarray, packing: Packing) -> list[Piece]:
    """Assign documents to sequences with the given capacities, which they fill exactly or leave room in."""
    room, cost = capacity.astype(np.int64), np.zeros(len(capacity))
    cost[room == 0] = np.inf
    pieces: list[Piece] = []

    def put(doc: int, start: int, length: int, k: int) -> None:
        pieces.append(Piece(doc, start, length, k, int(capacity[k] - room[k])))
        room[k] -= length
        cost[k] = np.inf if not room[k] else cost[k] + packing.linear * length + packing.quadratic * length * length

    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        start, left = 0, lengths[doc]
        while left:
            open_ = room >= min(left, packing.size)
            k = int(np.argmin(np.where(open_, cost, np.inf) if open_.any() else cost))
            take = int(min(left, room[k]))
            put(doc, start, take, k)
            start, left = start + take, left - take
    return pieces


def capacities(tokens: int, size: int) -> np.ndarray:
    """Full sequences, and powers of two for what is left."""
    rest = tokens % size
    return np.array([size] * (tokens // size) + [1 << b for b in range(size.bit_length(), -1, -1) if rest >> b & 1], np.int64)


def pack(docs: DataFrame, packing: Packing, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids`` (unless told otherwise), ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and ``sequence_length``.

    Each id lies in exactly one piece. A null or empty text is its end id alone. Repeated rows
    and rows with a null id are packed like any other, one by one. An empty table gives no row.
    A document longer than a block is cut where the block is full, and its rest opens the next.
    """
    rows = texts(docs).withColumn("partition", F.spark_partition_id())
    id_type = rows.schema["doc_id"].dataType.simpleString()
    full = packing.size * packing.block
    schema = {"doc_id": id_type, "start": "long", "length": "long", **({"ids": "array<int>"} if with_ids else {}), "ids_crc32": "long",
              "doc_tokens": "long", "sequence_id": "long", "offset": "long", "sequence_length": "long"}
    names = list(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = kept_codes(packing.path, _packed, packing.words)
        end = _packed([packing.end])
        held: list[tuple[object, np.ndarray, int, int]] = []  # id, ids still to place, their start, all tokens
        size = done = 0
        partition = 0

        def block(take: int) -> pa.RecordBatch:
            """Pack the first ``take`` tokens held; the document at the border is cut."""
            nonlocal held, size, done
            chosen, rest, count = [], [], 0
            for k, (doc, ids, start, tokens) in enumerate(held):
                if count == take:
                    rest = held[k:]
                    break
                part = ids[:take - count]
                chosen.append((doc, part, start, tokens))
                count += len(part)
                if len(part) < len(ids):
                    rest = [(doc, ids[len(part):], start + len(part), tokens), *held[k + 1:]]
                    break
            space = capacities(take, packing.size)
            pieces = fill([len(ids) for _, ids, _, _ in chosen], space, packing)
            parts = [chosen[p.doc][1][p.start:p.start + p.length] for p in pieces]
            columns = {
                "doc_id": pa.array([chosen[p.doc][0] for p in pieces], batch.column("doc_id").type),
                "start": pa.array([chosen[p.doc][2] + p.start for p in pieces], pa.int64()),
                "length": pa.array([p.length for p in pieces], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x) for x in parts], pa.int64()),
                "doc_tokens": pa.array([chosen[p.doc][3] for p in pieces], pa.int64()),
                "sequence_id": pa.array([(partition << 40) + done + p.sequence for p in pieces], pa.int64()),
                "offset": pa.array([p.offset for p in pieces], pa.int64()),
                "sequence_length": pa.array([int(space[p.sequence]) for p in pieces], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(
                    np.cumsum([0] + [len(x) for x in parts]).astype(np.int32), pa.array(np.concatenate(parts).astype(np.int32)))
            out = pa.RecordBatch.from_arrays([columns[c] for c in names], names)
            held, size, done = rest, size - take, done + len(space)
            return out

        for batch in batches:
            ids_ = batch.column("doc_id").to_pylist()
            if batch.num_rows:
                partition = batch.column("partition")[0].as_py()  # the same in all of a task's rows
            for k, text in enumerate(batch.column("text")):
                ids = np.frombuffer(b"".join([*map(codes.__getitem__, text.as_buffer().to_pybytes().split()), end]), "<u4")
                held.append((ids_[k], ids, 0, len(ids)))
                size += len(ids)
                while size >= full:
                    yield block(full)
        if size:
            yield block(size)

    return rows.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in schema.items()))

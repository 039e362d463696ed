"""Encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes of a text cuts it into chunks, so a passage that documents share
has the same chunks in all of them wherever it stands. A chunk is encoded once while it is
remembered, up to the parts of words at its two ends: those depend on the chunk beside it. Each
join is repaired by encoding the tail before it and the head after it together. The encoding
of a text is that of its words one after another, so the repaired stretch agrees with both
sides as soon as it reaches white space on both; a chunk without any is taken in whole and
the stretch goes on into the next chunk until it does.

Chunks are remembered per worker process, in a table of bounded size. Texts never
leave their task, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import texts
from tidemark.llm.wordcodes import PackedCodes

#: Bytes that the rolling hash sees, and the average length of a chunk (a power of two).
WINDOW, AVERAGE = 32, 1024
_SEEDS = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
_SPACE = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Coding:
    """``words`` and ``chunks`` bound the tables of one worker process."""

    path: str
    words: int = 400_000
    chunks: int = 10_000


def cuts(data: bytes, average: int = AVERAGE) -> list[int]:
    """Ends of the chunks: where the sum of the values of the last bytes, each rotated by its
    distance, has its low bits zero. It depends on these bytes alone."""
    values = _SEEDS.take(np.frombuffer(data, np.uint8))
    if len(values) <= WINDOW:
        return [len(data)]
    rolled, span = values.copy(), 1
    while span < WINDOW:
        older = rolled[:-span]
        rolled[span:] ^= older << np.uint32(span) | older >> np.uint32(32 - span)
        span *= 2
    rolled = rolled * np.uint32(2654435761)
    hit = rolled[WINDOW:] >> np.uint32(33 - average.bit_length()) == 0
    hit[1:] &= ~hit[:-1]  # a run of one byte is not cut at each
    ends = np.nonzero(hit)[0] + WINDOW + 1
    found = ends.tolist()
    if not found or found[-1] != len(data):
        found.append(len(data))
    return found


def _packed(ids: Sequence[int]) -> bytes:
    """32 bits for each id."""
    return array("I", ids).tobytes()


class Chunk:
    """Head and tail are parts of words; between them lie whole words, encoded."""

    __slots__ = ("head", "tail", "ids")

    def __init__(self, data: bytes, codes: PackedCodes) -> None:
        first = next((k for k, b in enumerate(data) if b in _SPACE), len(data))
        if first == len(data):  # no white space: all of it belongs to the join
            self.head, self.tail, self.ids = data, None, b""
            return
        last = max(data.rfind(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
        self.head, self.tail = data[:first], data[last + 1:]
        self.ids = b"".join([*map(codes.__getitem__, data[first:last].split())])


class Encoder:
    """Encodes texts chunk by chunk."""

    def __init__(self, coding: Coding) -> None:
        self.codes = PackedCodes(coding.path, _packed, coding.words)
        tokenizer = self.codes.tokenizer
        if tokenizer.decoder is not None:
            raise ValueError("decoding by words is exact only for a tokenizer that joins its tokens by spaces")
        # Each with a space after it, so that those of some ids, taken at once, lie in one buffer as joined text.
        self.numbers, self.names = (pa.array([f"{x} " for x in found], pa.large_string()) for found in zip(
            *((k, tokenizer.id_to_token(k) or "") for k in range(tokenizer.get_vocab_size()))))
        self.chunks: dict[bytes, Chunk] = {}
        self.limit = coding.chunks
        self.reused = self.made = 0

    def _chunk(self, data: bytes) -> Chunk:
        found = self.chunks.get(data)
        if found is None:
            if len(self.chunks) >= self.limit:
                self.chunks.clear()
            found = self.chunks[data] = Chunk(data, self.codes)
            self.made += 1
        else:
            self.reused += 1
        return found

    def encode(self, text: str) -> tuple[int, bytes, bytes]:
        """Number of ids, the ids in decimal joined by spaces, and the decoded text."""
        data, found = text.encode(), []
        pending, at = [], 0  # parts of the word that runs over the joins so far
        for end in cuts(data):
            chunk = self._chunk(data[at:end])
            at = end
            pending.append(chunk.head)
            if chunk.tail is None:
                continue
            if joint := b"".join(pending):
                found.append(self.codes[joint])
            found.append(chunk.ids)
            pending = [chunk.tail]
        if joint := b"".join(pending):
            found.append(self.codes[joint])
        ids = pa.array(np.frombuffer(b"".join(found), np.uint32))
        return len(ids), self._spelled(self.numbers, ids), self._spelled(self.names, ids)

    @staticmethod
    def _spelled(spellings: pa.LargeStringArray, ids: pa.UInt32Array) -> bytes:
        if not len(ids):
            return b""
        _, ends, data = spellings.take(ids).buffers()
        return data.slice(0, int(np.frombuffer(ends, np.int64, len(ids) + 1)[-1]) - 1).to_pybytes()


_ENCODERS: dict[Coding, Encoder] = {}


def coded(docs: DataFrame, coding: Coding) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (decimal, space-joined), ``ids_sha256``, ``decoded`` and
    ``decoded_sha256`` for each row.

    A null text counts as empty: no ids, an empty decoded text. Repeated rows each get their row,
    extra columns are left out, an empty table gives an empty result. Texts of any length are
    encoded whole.
    """
    rows = texts(docs)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if coding not in _ENCODERS:
            _ENCODERS[coding] = Encoder(coding)
        encoder = _ENCODERS[coding]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [encoder.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.string()), pa.array([hashlib.sha256(f[1]).hexdigest() for f in found], pa.string()),
                    pa.array([f[2] for f in found], pa.string()), pa.array([hashlib.sha256(f[2]).hexdigest() for f in found], pa.string()),
                ], ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256"])

    return rows.mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids string, ids_sha256 string, decoded string, decoded_sha256 string")

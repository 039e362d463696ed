"""Removal of lines that many documents share, by sharded minimal perfect hashes.

Lines are told apart by 128-bit hashes of their keys, which are dealt to shards by their top bits.

1. Each task gathers the lines of a block of documents and writes, for each shard, one packet: the
   different hashes, how many documents of the block have each, and which lines of which texts they are.
   A line or a text that a block holds a thousand times is in its packets once.
2. A shard adds the counts of its packets and builds a minimal perfect hash over its hashes, with an
   array of fingerprints and one of counts: some 8 bytes a line.
3. A shard's arrays come first and its packets stream past them. What comes back is, for each
   text that loses lines, their numbers. The lines themselves are never shuffled or joined.

Texts are named by a 128-bit hash too, so results do not depend on the order of rows or partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import settled, texts
from tidemark.llm.perfect_hash import PerfectHash

#: Lines gathered into the packets of one block; lines of a shard.
BLOCK, SHARD = 1 << 18, 1 << 20

_PACKET = "shard int, lines binary, docs binary, texts binary, refs binary"
_INDEX = "shard int, sizes binary, words binary, fingerprints binary, counts binary"


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of two words in the order of the second, and the number of each row among them."""
    by = np.lexsort((keys[:, 0], keys[:, 1]))
    new = np.ones(len(by), bool)
    new[1:] = (keys[by[1:]] != keys[by[:-1]]).any(axis=1)
    which = np.empty(len(by), np.int64)
    which[by] = np.cumsum(new) - 1
    return keys[by[new]], which


class _Block:
    """Lines of some documents."""

    def __init__(self) -> None:
        self.seen: dict[bytes, int] = {}  # text -> its number
        self.times: list[int] = []
        self.hashes: list[bytes] = []
        self.text: list[int] = []
        self.line: list[int] = []

    def add(self, text: bytes, least: int) -> None:
        name = hashlib.md5(text).digest()
        k = self.seen.get(name)
        if k is not None:
            self.times[k] += 1
            return
        k = self.seen[name] = len(self.seen)
        self.times.append(1)
        for i, line in enumerate(text.lower().split(b"\n")):  # of bytes: A-Z only
            key = line.strip()  # of bytes: exactly the six ASCII white spaces
            if key and (len(key) >= 4 * least or len(key.decode()) >= least):
                self.hashes.append(xxhash.xxh3_128_digest(key))
                self.text.append(k)
                self.line.append(i)

    def packets(self, bits: int) -> pa.RecordBatch:
        keys, which = _distinct(np.frombuffer(b"".join(self.hashes), "<u8").reshape(-1, 2))
        text, line = np.array(self.text, np.int64), np.array(self.line, np.uint32)
        # A document counts once for a line that it repeats.
        pairs = np.unique(which * len(self.times) + text)
        docs = np.bincount(pairs // len(self.times), np.array(self.times)[pairs % len(self.times)], len(keys)).astype(np.uint64)
        by = np.argsort(which, kind="stable")
        which, text, line = which[by], text[by], line[by]
        shard = (keys[:, 1] >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(keys), np.int32)
        tops = np.concatenate([np.nonzero(np.diff(shard))[0] + 1, [len(keys)]]) if len(keys) else np.zeros(0, np.int64)
        names = np.frombuffer(b"".join(self.seen), "V16")
        rows, at = [], 0
        for top in tops.tolist():
            lo, hi = np.searchsorted(which, [at, top])
            own, local = np.unique(text[lo:hi], return_inverse=True)
            refs = np.stack([which[lo:hi] - at, local, line[lo:hi]]).astype("<u4")
            rows.append((int(shard[at]), keys[at:top].tobytes(), docs[at:top].tobytes(), names[own].tobytes(), refs.tobytes()))
            at = top
        kinds = [pa.int32()] + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds)], ["shard", "lines", "docs", "texts", "refs"])


def packets(docs: DataFrame, least: int, bits: int) -> DataFrame:
    """The lines of all documents, packed by block and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            for text in batch.column("text"):
                block.add(text.as_buffer().to_pybytes(), least)
                if len(block.hashes) + len(block.seen) >= BLOCK:
                    yield block.packets(bits)
                    block = _Block()
        yield block.packets(bits)

    return texts(docs).select("text").mapInArrow(run, _PACKET)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[dict]]]:
    """Rows, which come sorted by shard, one shard after another."""
    from itertools import groupby

    rows = ({c: batch.column(c)[k] for c in batch.schema.names} for batch in batches for k in range(batch.num_rows))
    return ((shard, group) for shard, group in groupby(rows, lambda r: r["shard"].as_py()))


def _array(value: pa.BinaryScalar, kind: str) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def index(packed: DataFrame, most: int) -> DataFrame:
    """For each shard the perfect hash of its lines with their fingerprints and counts, these up to ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            keys, counts = np.zeros((0, 2), "<u8"), np.zeros(0, np.uint64)
            held, size = [], 0

            def merge() -> None:
                nonlocal keys, counts, held, size
                joined = np.concatenate([keys, *[k for k, _ in held]])
                weight = np.concatenate([counts, *[c for _, c in held]])
                keys, which = _distinct(joined)
                # Integers as doubles are exact up to 2^53 documents.
                counts = np.bincount(which, weight, len(keys)).astype(np.uint64)
                held, size = [], 0

            for row in rows:
                held.append((_array(row["lines"], "<u8").reshape(-1, 2), _array(row["docs"], "<u8")))
                size += len(held[-1][1])
                if size > max(BLOCK, len(keys)):
                    merge()
            merge()
            made = PerfectHash.of(keys, counts, most)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (made.sizes, made.words, made.fingerprints, made.counts)]],
                ["shard", "sizes", "words", "fingerprints", "counts"])

    return packed.select("shard", "lines", "docs").repartition("shard").sortWithinPartitions("shard").mapInArrow(run, _INDEX)


def _met(indexed: DataFrame, packed: DataFrame, documents: int, most: int) -> DataFrame:
    """``name`` of a text and ``line``, the number of a line of it that at least ``documents`` documents have."""
    kind = "u2" if most < 1 << 16 else "u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_shard(batches):
            known = None
            for row in rows:
                if row["sizes"].is_valid:
                    known = PerfectHash(*[_array(row[c], t) for c, t in (("sizes", "<i8"), ("words", "<u8"), ("fingerprints", "<u4"), ("counts", kind))])
                    continue
                keys = _array(row["lines"], "<u8").reshape(-1, 2)
                often = known.count(keys) >= documents if known else np.zeros(len(keys), bool)
                which, text, line = _array(row["refs"], "<u4").reshape(3, -1)
                gone = often[which]
                names = _array(row["texts"], "V16")[text[gone]]
                yield pa.RecordBatch.from_arrays(
                    [pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(names), [None, pa.py_buffer(names.tobytes())]).cast(pa.binary()),
                     pa.array(line[gone].astype(np.int32))], ["name", "line"])

    # The arrays of a shard sort before its packets.
    both = indexed.select("shard", F.lit(0).alias("kind"), "sizes", "words", "fingerprints", "counts").unionByName(
        packed.select("shard", F.lit(1).alias("kind"), "lines", "texts", "refs"), allowMissingColumns=True)
    return both.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(run, "name binary, line int")


def without_common_lines(docs: DataFrame, documents: int = 10, least: int = 1) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped``, ``kept`` and ``kept_sha256`` for each row.

    A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Keys of
    at least ``least`` code points that at least ``documents`` documents have lose all their lines. Each
    row is a document, repeated rows and rows with a null id too. A null or empty text is one empty line,
    whose key has no code points. Extra columns are left out; an empty table gives no row.
    """
    if least < 1 or documents < 1:
        raise ValueError("least and documents are 1 or more")
    rows = texts(docs)
    lines = rows.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1).alias("n")).first()["n"] or 0
    bits = max(4, (lines // SHARD).bit_length())
    most = max(documents, (1 << 16) - 1)
    packed = settled(packets(docs, least, bits))
    indexed = settled(index(packed, most))
    gone = _met(indexed, packed, documents, most).groupBy("name").agg(F.collect_set("line").alias("gone"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, dropped, kept, digest = [], [], [], []
            for text, out in zip(batch.column("text"), batch.column("gone")):
                raw = text.as_buffer().to_pybytes()
                found = out.values.to_pylist() if out.is_valid else []
                if found:
                    left = raw.split(b"\n")
                    total.append(len(left))
                    for i in found:
                        left[i] = None
                    raw = b"\n".join([x for x in left if x is not None])
                else:
                    total.append(raw.count(b"\n") + 1)
                dropped.append(len(found))
                kept.append(raw)
                digest.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(digest, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept", "kept_sha256"])

    named = rows.withColumn("name", F.unhex(F.md5(F.col("text").cast("binary"))))
    return named.join(gone, "name", "left").select("doc_id", "text", "gone").mapInArrow(
        run, f"doc_id {id_type}, n_lines long, n_dropped long, kept string, kept_sha256 string")

"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of a covering code: the direct product of two binary Golay codes over
the first 46 bits and the trivial code {0} over the last 18. A Golay code is perfect with
covering radius 3, so each half of a fingerprint has exactly one code word within 3 bits, and
the pair of them is the fingerprint's home anchor. A fingerprint at distance t or less from
another, t1 bits apart in the first half and t2 in the second, lies within (3 + t1, 3 + t2) of
the other's home anchor. So every fingerprint is replicated to all anchors within covering
radius plus threshold, per block and with t1 + t2 <= t; compared with the fingerprints at home
there, no pair can be missed. For t = 2 these are about 61 of the 16.7 million anchors.

Only distinct fingerprints are replicated: any number of exact copies is one row before the
first shuffle. Rows of an anchor are streamed against its home fingerprints, and only links
that join two groups of them leave the task, so a dense group of n fingerprints gives about n
links, not n squared. An anchor with more than ``hot`` home fingerprints is divided by the
finest covering code, that of all 64-bit words with radius zero: its fingerprints are compared
per word, each of which has one at home and at most 2,081 around it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import settled, texts, without_tables
from tidemark.llm.components import components

BITS, HALF, RADIUS = 64, 23, 3
#: The generator polynomial of the binary Golay code.
GOLAY = 0b110001110101


def fingerprint(text: str | None, shingle: int) -> int:
    """Bit i is set when it is set in over half of the hashes of the word shingles."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z only, and the six ASCII white spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    tops = (ends - 1).tolist()
    size = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], 42) for a, b in zip(starts, tops[size - 1:])])
    total, counts = len(hashes) // 8, np.zeros(BITS, np.int64)
    raw = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for at in range(0, total, 1 << 16):
        counts += np.unpackbits(raw[at:at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint's bits as a long; a text without words has zero."""
    rows = texts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        without_tables()
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())], ["doc_id", "fp"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, fp long")


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words modulo the generator polynomial."""
    left = words.astype(np.int64)
    for bit in range(HALF - 1, 10, -1):
        left = np.where(left >> bit & 1, left ^ (GOLAY << (bit - 11)), left)
    return left


@lru_cache(4)
def patterns(reach: int) -> list[list[np.ndarray]]:
    """By syndrome, then by t from 0 to reach: the errors of weight RADIUS + t, or of RADIUS at
    most for t = 0. XOR with one leads from a word to a code word at that distance."""
    by: list[list[list[int]]] = [[[] for _ in range(reach + 1)] for _ in range(1 << 11)]
    for weight in range(RADIUS + reach + 1):
        errors = np.array([sum(1 << b for b in c) for c in combinations(range(HALF), weight)])
        for s, e in zip(syndromes(errors).tolist(), errors.tolist()):
            by[s][max(0, weight - RADIUS)].append(e)
    return [[np.array(x, np.int64) for x in parts] for parts in by]


def halves(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << HALF) - 1)
    return (fps >> np.uint64(BITS - HALF) & mask).astype(np.int64), (fps >> np.uint64(BITS - 2 * HALF) & mask).astype(np.int64)


def home_anchors(fps: np.ndarray) -> np.ndarray:
    """The pair of nearest code words; unique, as the code is perfect."""
    leaders = np.array([parts[0][0] for parts in patterns(0)])
    a, b = (half ^ leaders[syndromes(half)] for half in halves(fps))
    return a << HALF | b


def anchors(fps: np.ndarray, reach: int) -> list[np.ndarray]:
    """For each fingerprint all anchors it is replicated to, its home anchor first."""
    table, found = patterns(reach), []
    splits = [(t1, t2) for t1 in range(reach + 1) for t2 in range(reach + 1 - t1)]
    for a, b, s1, s2 in zip(*(x.tolist() for half in zip(*((h, syndromes(h)) for h in halves(fps))) for x in half)):
        first, second = [a ^ e for e in table[s1]], [b ^ e for e in table[s2]]
        found.append(np.concatenate([(first[t1][:, None] << HALF | second[t2]).ravel() for t1, t2 in splits]))
    return found


def _replicate(reach: int, hot: np.ndarray):
    """Rows (anchor, point, guest, fp); ``point`` is zero but in hot anchors."""
    around = np.array([sum(1 << b for b in c) for w in range(reach + 1) for c in combinations(range(BITS), w)], np.uint64)

    def rows(anchor, point, guest, fp) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(point.view(np.int64)), pa.array(guest), pa.array(fp.view(np.int64))],
            ["anchor", "point", "guest", "fp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(fps), 4096):
                part = fps[at:at + 4096]
                found = anchors(part, reach)
                sizes = np.array([len(a) for a in found])
                anchor, fp = np.concatenate(found), np.repeat(part, sizes)
                guest = np.ones(len(fp), bool)
                guest[np.cumsum(sizes) - sizes] = False
                dense = np.isin(anchor, hot)
                yield rows(anchor[~dense], np.zeros((~dense).sum(), np.uint64), guest[~dense], fp[~dense])
                for x in np.unique(fp[dense]):
                    points = x ^ around
                    own = home_anchors(points)
                    near = np.isin(own, hot)
                    yield rows(own[near], points[near], points[near] != x, np.full(near.sum(), x))

    return run


class _Homes:
    """The home fingerprints of one anchor, and which of them are known to be connected."""

    def __init__(self, fps: np.ndarray) -> None:
        self.fps, self.group = fps, np.arange(len(fps))

    def links(self, fps: np.ndarray, limit: int, block: int = 1 << 22) -> Iterator[tuple[int, int]]:
        """A link to a home for each near fingerprint, and one for each two groups it joins."""
        step = max(1, block // len(self.fps))
        for at in range(0, len(fps), step):
            part = fps[at:at + step]
            near = np.bitwise_count(part[:, None] ^ self.fps) <= limit
            for i in np.nonzero(near.any(axis=1))[0]:
                found = np.nonzero(near[i])[0]
                yield int(part[i]), int(self.fps[found[0]])
                groups = np.unique(self.group[found])
                for other in groups[1:]:
                    yield int(self.fps[groups[0]]), int(self.fps[other])
                    self.group[self.group == other] = groups[0]


def _compare(limit: int):
    """Rows come sorted by anchor and point, home fingerprints first; the homes of one are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, waiting, held, out = None, [], None, []

        def finish() -> None:
            nonlocal held
            if held is None and waiting:
                held = _Homes(np.concatenate(waiting))
                if len(held.fps) > 1:
                    out.extend(held.links(held.fps, limit))

        def linked() -> Iterator[pa.RecordBatch]:
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            out.clear()
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, point = batch.column("anchor").to_numpy(), batch.column("point").to_numpy()
            guest = batch.column("guest").to_numpy(zero_copy_only=False)
            fps = batch.column("fp").to_numpy().view(np.uint64)
            cuts = np.concatenate([[0], np.nonzero((np.diff(anchor) != 0) | (np.diff(point) != 0))[0] + 1, [len(anchor)]])
            homes = np.add.reduceat((~guest).astype(np.int64), cuts[:-1])
            # Most anchors have nobody at home, or nobody else: nothing to compare. The first may
            # go on from the last batch, and the last into the next one.
            busy = (homes > 0) & (np.diff(cuts) > 1)
            busy[0] |= (anchor[0], point[0]) == last
            busy[-1] |= homes[-1] > 0
            for k in np.nonzero(busy)[0]:
                a, b = int(cuts[k]), int(cuts[k + 1])
                if (key := (anchor[a], point[a])) != last:
                    finish()
                    last, waiting, held = key, [], None
                inside = guest[a:b]
                if not inside.all():
                    waiting.append(fps[a:b][~inside])
                if inside.any():
                    finish()
                    if held is not None:
                        out.extend(held.links(fps[a:b][inside], limit))
            yield from linked()
        finish()
        yield from linked()

    return run


def links(distinct: DataFrame, limit: int, hot: int) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints ``fp`` at ``limit`` or fewer differing bits."""

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(home_anchors(batch.column("fp").to_numpy().view(np.uint64)))], ["home"])

    # At most one anchor in ``hot`` fingerprints, so the list is small whatever the input.
    crowded = distinct.mapInArrow(homes, "home long").groupBy("home").count().where(F.col("count") > hot).select("home").collect()
    rows = distinct.mapInArrow(
        _replicate(limit, np.array([r[0] for r in crowded], np.int64)), "anchor long, point long, guest boolean, fp long")
    return (rows.repartition("anchor", "point").sortWithinPartitions("anchor", "point", "guest")
            .mapInArrow(_compare(limit), "a long, b long").where("a <> b").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, limit: int = 2, hot: int = 1 << 16) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable.

    One row per input row. Null and empty texts have fingerprint zero and are linked like any
    other. Null ids take part; a component's id is its smallest id that is not null.
    """
    rows = settled(fingerprints(docs, shingle))
    distinct = settled(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(links(distinct.select("fp"), limit, hot))  # linked ones only
    named = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = named.join(smallest, "component").select(F.col("fp").alias("of"), "component_id")
    return rows.join(classes, rows["fp"] == classes["of"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

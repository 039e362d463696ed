"""Long repeats over a corpus, decided shard by shard.

A window is ``length`` consecutive symbols (words or bytes) of one text. Each window has an
anchor: the smallest hash among its n-grams. Equal windows have equal anchors, so consecutive
windows with one anchor travel together as a segment, and a repeat can only be found among
segments of one anchor. That splits the corpus into shards by content instead of by document:

1. Anchors that occur once in the corpus are dropped by counting; nothing else about them is moved.
2. Equal segments collapse to one row with their first and last occurrence, so a passage in a
   third of all documents is one row. Two places are two copies, whatever lies between them.
3. Only anchors with several different segments need an index. The text of one occurrence
   of each is fetched, dealt out by anchor, and gathered into shards of bounded size.
4. A shard operator returns for each segment a bit per window. The occurrences
   are joined with these bits, and gathered per document.

An anchor with more than ``dense`` different segments is not put into one index: its windows are
dealt out one by one, by their own hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import settled, texts, without_tables

#: Windows of a segment at most; their bits fit a long.
PIECE = 64
CHUNK = 1 << 18
#: Texts that are cut and returned together.
ROWS = 256

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

@dataclass(frozen=True)
class Shape:
    """Windows of ``length`` symbols, anchored by n-grams of ``gram`` symbols."""

    length: int
    gram: int
    dense: int = 20_000
    shard: int = 1 << 19


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a 64-bit value."""
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))


class _WordHashes(dict):
    """Hash of a word, remembered up to a bounded number of words."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _WordHashes()


@dataclass(frozen=True)
class Alphabet:
    """How a text becomes an array of symbols, and these 64-bit values that hash well."""

    dtype: str
    split: Callable[[str], np.ndarray]
    values: Callable[[np.ndarray], np.ndarray]


def _split_words(text: str) -> np.ndarray:
    words = text.encode().split()  # bytes split at exactly the six ASCII white spaces
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


WORDS = Alphabet("uint64", _split_words, lambda x: x)
BYTES = Alphabet("uint8", lambda text: np.frombuffer(text.encode(), np.uint8), lambda x: _BYTE_VALUES[x])

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    if n > CHUNK + 1:
        return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, b, np.uint64)])) for b in (_BASE, _INVERSE))
    if not _POWERS:
        _POWERS[0] = _powers(CHUNK + 2)
    return tuple(p[:n] for p in _POWERS[0])


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    span = 1
    while span * 2 <= size:
        x, span = np.minimum(x[:-span], x[span:]), span * 2
    return np.minimum(x[:len(x) - (size - span)], x[size - span:]) if size > span else x


def segments(symbols: np.ndarray, lens: np.ndarray, shape: Shape) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: start, windows, anchor, hash and ``own`` of each segment.

    ``own`` is set when the segment may hold two equal windows itself: its anchor n-gram
    then occurs twice in it.
    """
    n, length, wide = len(symbols), shape.length, shape.length - shape.gram + 1
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, bool))
    power, inverse = _powers(n + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(symbols * power[:n])])
    grams = mixed((sums[shape.gram:] - sums[:-shape.gram]) * inverse[:n - shape.gram + 1])
    least = sliding_min(grams, wide)
    ends = np.repeat(np.cumsum(lens), lens)
    valid = np.arange(n - length + 1) + length <= ends[:n - length + 1]
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    starts = np.nonzero(begins)[0]
    if not len(starts):
        return segments(symbols[:0], lens[:0], shape)
    counts = np.add.reduceat(valid.astype(np.int64), starts)
    if counts.max() > PIECE:
        parts = -(-counts // PIECE)
        offset = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * PIECE
        starts, counts = np.repeat(starts, parts) + offset, np.minimum(np.repeat(counts, parts) - offset, PIECE)
    anchor = least[starts]
    stops = starts + counts + length - 1
    whole = mixed((sums[stops] - sums[starts]) * inverse[starts] + counts.astype(np.uint64))
    # Places of n-grams that are the smallest of some window, and those followed by an equal one.
    # Between two equal ones no further apart than a window there is no other such place.
    reach = np.concatenate([np.zeros(wide - 1, np.uint64), least, np.zeros(wide - 1, np.uint64)])
    places = np.nonzero(grams == ~sliding_min(~reach, wide))[0]
    again = np.zeros(len(places) + 1, np.int64)
    again[1:-1] = np.cumsum(grams[places[:-1]] == grams[places[1:]])[: max(0, len(places) - 1)]
    again[-1] = again[-2] if len(places) > 1 else 0
    first, last = np.searchsorted(places, starts), np.searchsorted(places, starts + counts + wide - 1)
    own = again[np.maximum(last - 1, first)] > again[first]
    return starts, counts, anchor, whole, own


#: A place packs the low bits of the text's hash, the start, the windows and ``own`` of a segment.
def places(tag: np.ndarray, start: np.ndarray, windows: np.ndarray, own: np.ndarray) -> np.ndarray:
    return tag << 40 | start << 8 | windows << 1 | own


def _tagged(docs: DataFrame) -> DataFrame:
    """``tag`` tells apart different texts given under one id, ``mark`` those without any; equal rows count as
    one document. ``row`` holds the whole row."""
    row = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("row")
    return texts(docs.select(row, docs["doc_id"], docs["text"]), "row").withColumns({
        "tag": F.xxhash64("text").bitwiseAND(F.lit((1 << 23) - 1)),
        # As many documents as one likes may have no id, so these need all bits of a hash of their own.
        "mark": F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(1), "text")).otherwise(F.lit(0).cast("long"))})


def _of_one_document(rows: DataFrame, found: DataFrame) -> Column:
    """Join of rows with what was ``found`` of them, by id, mark and tag."""
    return rows["doc_id"].eqNullSafe(found["of"]) & (rows["mark"] == found["of_mark"]) & (rows["tag"] == found["of_tag"])


def _occurrences(rows: DataFrame, alphabet: Alphabet, shape: Shape) -> DataFrame:
    """All segments of all texts. Long texts go in overlapping parts, so memory has a bound."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def found(batch: pa.RecordBatch, parts: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        row, offset = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
        lens = np.array([len(p[2]) for p in parts])
        starts, counts, anchor, whole, own = segments(alphabet.values(np.concatenate([p[2] for p in parts])), lens, shape)
        tops = np.cumsum(lens)
        part = np.searchsorted(tops, starts, side="right")
        doc = row[part]
        place = places(batch.column("tag").to_numpy()[doc], starts - (tops - lens)[part] + offset[part], counts, own)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)), batch.column("doc_id").take(pa.array(doc)),
             batch.column("mark").take(pa.array(doc)), pa.array(place)],
            ["anchor", "segment", "doc_id", "mark", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        without_tables()
        for batch in batches:
            parts, size = [], 0
            for k, text in enumerate(batch.column("text")):
                values = alphabet.split(text.as_py())
                for at in range(0, len(values) - shape.length + 1, CHUNK):
                    part = values[at:at + CHUNK + shape.length - 1]
                    if parts and size + len(part) > CHUNK:
                        yield found(batch, parts)
                        parts, size = [], 0
                    parts.append((k, at, part))
                    size += len(part)
            if parts:
                yield found(batch, parts)

    return rows.mapInArrow(run, f"anchor long, segment long, doc_id {id_type}, mark long, place long")


#: Of one shard: texts, windows of each, whether each has several copies, and the rank of its
#: first occurrence's document and its start there; returns bits for each window.
ShardWork = Callable[[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _shards(work: ShardWork, shape: Shape, dtype: str):
    def solve(rows: pa.Table) -> pa.RecordBatch:
        place = rows.column("place").to_numpy()
        texts_ = [np.frombuffer(x, dtype) for x in rows.column("symbols").to_pylist()]
        keys = pa.table({"d": rows.column("doc_id"), "m": rows.column("mark"), "t": pa.array(place >> 40)})
        ranks = np.zeros(len(place), np.int64)
        by = pc.sort_indices(keys, sort_keys=[("d", "ascending"), ("m", "ascending"), ("t", "ascending")], null_placement="at_start").to_numpy()
        docs = keys.take(pa.array(by))
        change = np.zeros(len(by), np.int64)
        if len(by) > 1:
            d = docs.column("d").combine_chunks()
            same = pc.fill_null(pc.equal(d[1:], d[:-1]), False).to_numpy(zero_copy_only=False)
            nulls = d.is_null().to_numpy(zero_copy_only=False)
            m, t = docs.column("m").to_numpy(), docs.column("t").to_numpy()
            change[1:] = ~((same | (nulls[1:] & nulls[:-1])) & (m[1:] == m[:-1]) & (t[1:] == t[:-1]))
        ranks[by] = np.cumsum(change)
        copies = rows.column("copies").to_numpy()
        bits = work(texts_, place >> 1 & 127, copies, ranks, place >> 8 & 0xFFFFFFFF)
        return pa.RecordBatch.from_arrays(
            [rows.column("anchor").combine_chunks(), rows.column("segment").combine_chunks(), pa.array(bits.view(np.int64))],
            ["anchor", "segment", "bits"]).filter(pa.array(bits != 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole anchors are gathered until a shard is full; rows come sorted by anchor and segment."""
        without_tables()
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column("anchor").to_numpy()
            cuts = np.concatenate([[0], np.nonzero(np.diff(anchor))[0] + 1, [len(anchor)]])
            lens = pc.binary_length(batch.column("symbols")).to_numpy() // np.dtype(dtype).itemsize
            total = np.add.reduceat(lens, cuts[:-1])
            at = 0
            for k in range(len(cuts) - 1):
                follows = k == 0 and held and held[-1].column("anchor")[-1].as_py() == anchor[0]
                if size + total[k] > shape.shard and size and not follows:
                    if cuts[k] > at:
                        held.append(batch.slice(at, cuts[k] - at))
                    yield solve(pa.Table.from_batches(held))
                    held, size, at = [], 0, cuts[k]
                size += int(total[k])
            held.append(batch.slice(at))
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


def _fetch(rows: DataFrame, need: DataFrame, alphabet: Alphabet, shape: Shape) -> DataFrame:
    """The symbols of the first occurrence of each needed segment, from the texts."""
    wanted = need.groupBy(F.col("first.doc_id").alias("of"), F.col("first.mark").alias("of_mark"), F.shiftright("first.place", 40).alias("of_tag")).agg(
        F.collect_list(F.struct("anchor", "segment", "copies", F.col("first.place").alias("place"))).alias("wanted"))
    id_type, length = rows.schema["doc_id"].dataType.simpleString(), shape.length
    names = ["anchor", "segment", "copies", "doc_id", "mark", "place", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        without_tables()
        for batch in batches:
            held, size = [], 0
            for k in range(batch.num_rows):
                want = batch.column("wanted").slice(k, 1).flatten()
                place = want.field("place").to_numpy()
                values = alphabet.split(batch.column("text")[k].as_py())
                start, windows = place >> 8 & 0xFFFFFFFF, place >> 1 & 127
                cut = [values[s:s + m + length - 1].tobytes() for s, m in zip(start.tolist(), windows.tolist())]
                doc, mark = (batch.column(c).take(pa.array(np.full(len(cut), k))) for c in ("doc_id", "mark"))
                held.append(pa.RecordBatch.from_arrays(
                    [want.field("anchor"), want.field("segment"), want.field("copies"), doc, mark, want.field("place"), pa.array(cut, pa.binary())], names))
                size += sum(map(len, cut))
                if size > 1 << 23:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, size = [], 0
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return rows.join(wanted, _of_one_document(rows, wanted)).select("doc_id", "mark", "text", "wanted").mapInArrow(
        run, f"anchor long, segment long, copies boolean, doc_id {id_type}, mark long, place long, symbols binary")


def repeats(docs: DataFrame, alphabet: Alphabet, shape: Shape, work: ShardWork, others_only: bool) -> DataFrame:
    """``row``, ``doc_id``, ``text``, ``tag`` and ``found``, the list of (place, bits) of its repeated windows.

    With ``others_only`` the first occurrence of a segment goes by its bits and all others are
    repeats; otherwise every occurrence of a segment with several copies is a repeat.
    """
    whole_rows = _tagged(docs)
    rows = whole_rows.select("doc_id", "text", "tag", "mark")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    # 1. Anchors that can repeat, and the occurrences of their segments.
    met = settled(_occurrences(rows, alphabet, shape).groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("place").bitwiseAND(1)).alias("own")).where("n > 1 or own = 1").select("anchor"))
    occurrences = settled(_occurrences(rows, alphabet, shape).join(met, "anchor", "left_semi"))

    # 2. Different segments, and the anchors that have several.
    spot = F.struct("doc_id", "mark", "place")
    distinct = settled(occurrences.groupBy("anchor", "segment").agg(F.min(spot).alias("first"), F.max(spot).alias("last"))
                       .select("anchor", "segment", "first", (F.col("first") != F.col("last")).alias("copies")))
    wide = distinct.groupBy(F.col("anchor").alias("of")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("first.place").bitwiseAND(1)).alias("own")).where("n > 1 or own = 1")
    need = distinct.join(wide, F.col("anchor") == F.col("of"))

    # 3. The text of one occurrence of each, shard by shard.
    bits = (_fetch(rows, need.where(F.col("n") <= shape.dense), alphabet, shape).repartition("anchor").sortWithinPartitions("anchor", "segment")
            .mapInArrow(_shards(work, shape, alphabet.dtype), "anchor long, segment long, bits long"))
    if wide.where(F.col("n") > shape.dense).limit(1).count():
        crowded = settled(_fetch(rows, need.where(F.col("n") > shape.dense), alphabet, shape))
        bits = bits.unionByName(_dense(crowded, alphabet.dtype, shape, id_type, others_only))
    bits = settled(bits.groupBy("anchor", "segment").agg(F.bit_or("bits").alias("bits")))

    # 4. Occurrences of repeated windows, gathered per document.
    known = distinct.join(bits, ["anchor", "segment"], "left").select(
        "anchor", "segment", "first", "copies", F.coalesce("bits", F.lit(0)).alias("bits")).where("copies or bits <> 0")
    at_first = F.struct("doc_id", "mark", "place") == F.col("first")  # nulls in a struct are equal
    whole: Column = ~at_first if others_only else F.col("copies")
    found = occurrences.join(known, ["anchor", "segment"]).select(
        F.col("doc_id").alias("of"), F.col("mark").alias("of_mark"), F.shiftright("place", 40).alias("of_tag"), "place", F.when(whole, F.lit(-1).cast("long")).otherwise(F.col("bits")).alias("bits"))
    per_doc = found.where("bits <> 0").groupBy("of", "of_mark", "of_tag").agg(F.collect_list(F.struct("place", "bits")).alias("found"))
    return whole_rows.join(per_doc, _of_one_document(whole_rows, per_doc), "left").select("row", "doc_id", "text", "tag", "found")


def _dense(fetched: DataFrame, dtype: str, shape: Shape, id_type: str, others_only: bool) -> DataFrame:
    """Bits of anchors with very many segments: windows meet by their own hash, two times 64 bits,
    counted before they are shuffled."""
    size, length = np.dtype(dtype).itemsize, shape.length

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, value in enumerate(batch.column("symbols").to_pylist()):
                parts = [value[j * size:(j + length) * size] for j in range(len(value) // size - length + 1)]
                row = pa.array(np.full(len(parts), k))
                place = batch.column("place")[k].as_py()
                hashes = np.frombuffer(b"".join(xxhash.xxh128_digest(p) for p in parts), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("anchor").take(row), batch.column("segment").take(row), batch.column("doc_id").take(row), batch.column("mark").take(row),
                     pa.array(np.arange(len(parts)) + (place >> 8)), pa.array(np.arange(len(parts))),
                     pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), batch.column("copies").take(row)],
                    ["anchor", "segment", "doc_id", "mark", "at", "j", "h1", "h2", "copies"])

    seen = fetched.mapInArrow(
        windows, f"anchor long, segment long, doc_id {id_type}, mark long, at long, j long, h1 long, h2 long, copies boolean").withColumn(
        "spot", F.struct("doc_id", "mark", "at"))
    first = seen.groupBy("h1", "h2").agg(F.min("spot").alias("lo"), F.max("spot").alias("hi"))
    again = F.col("spot") != F.col("lo") if others_only else F.col("lo") != F.col("hi")
    return seen.join(first, ["h1", "h2"]).where(again).groupBy("anchor", "segment").agg(
        F.bit_or(F.expr("shiftleft(1L, cast(j as int))")).alias("bits"))


def covered(n: int, found, tag: int, length: int) -> np.ndarray:
    """Which of n symbols lie in a repeated window; ``found`` is a struct array or None."""
    if found is None or not len(found):
        return np.zeros(n, bool)
    place, bits = found.field("place").to_numpy(), found.field("bits").to_numpy()
    mine = place >> 40 == tag
    place, bits = place[mine], np.ascontiguousarray(bits[mine])
    start, windows = place >> 8 & 0xFFFFFFFF, place >> 1 & 127
    on = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
    on &= np.arange(PIECE) < windows[:, None]
    begun = np.cumsum(np.bincount((start[:, None] + np.arange(PIECE))[on], minlength=n))
    begun[length:] -= begun[:-length].copy()
    return begun > 0

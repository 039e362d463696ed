"""Information-theoretic sanitisation of personal data.

Fixed patterns find protected entities: addresses, numbers. What stands beside them can give them away
too. Over the corpus, n(t, e) documents hold the term t within a few words of the entity e,
n(t) hold t anywhere, n(e) hold e. The pointwise information of t about e, log2(N n(t, e) / (n(t) n(e))), as
a share of the entity's own information, log2(N / n(e)), is how far t discloses e: 1 when t is only ever met
beside e. A term seen beside its entity in several documents whose disclosure reaches a threshold
is replaced by its general form wherever it stands in a document that holds the entity. At a higher threshold it
is removed, from every document of the corpus.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import settled, texts

#: Base kinds as listed, then those of the method.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "general", "removed")

# Starts inside a run of digits are skipped: a match from the start of the run would come first. A
# domain is searched from its @, as the name before it is all that the alphabet allows.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NAME = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\S+")  # as str.split()
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


@dataclass(frozen=True)
class Policy:
    """``reach`` words on either side, ``support`` documents, and the two thresholds of disclosure."""

    reach: int = 4
    support: int = 3
    general: float = 0.8
    remove: float = 0.95
    counted: int = 300_000  # terms a task holds before it passes their counts on
    marks: int = 24  # power of two of the bits that tell which terms may be disclosing


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # end of the last match
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _NAME_CHARS:
            start -= 1
        if start < m.start():
            free = m.end()
            yield start, free


def _luhn(digits: str) -> bool:
    total = sum(int(d) if k % 2 == 0 else (2 * int(d) - 9 if int(d) > 4 else 2 * int(d)) for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _low(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255


def entities(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base kinds: leftmost, not overlapping within a kind."""
    found = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_low, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return found


def term_of(word: str) -> str:
    """A word's form for counting: composed small letters without the signs around it, or nothing if it is all signs."""
    if not word.isalnum():
        a, b = _bare(word)
        word = word[a:b].replace("\u2019", "'")
    return word.lower() if word.isascii() else unicodedata.normalize("NFC", unicodedata.normalize("NFC", word).lower())


def _bare(word: str) -> tuple[int, int]:
    """Start and end of a word from its first to its last letter, digit or mark, without 's; signs inside it stay."""
    start, end = 0, len(word)
    while start < end and not _spells(word[start]):
        start += 1
    while start < end and not _spells(word[end - 1]):
        end -= 1
    if end - start > 2 and word[end - 2] in "'\u2019" and word[end - 1] in "sS":
        end -= 2
        while start < end and not _spells(word[end - 1]):
            end -= 1
    return start, end


def _spells(c: str) -> bool:
    return c.isalnum() or unicodedata.category(c)[0] == "M"


def _term_hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode()) - (1 << 63)


def _entity(text: str, kind: int, start: int, end: int) -> int:
    value = "".join(c for c in text[start:end].lower() if c.isalnum() or c == "@")
    return xxhash.xxh64_intdigest(f"{kind}:{value}".encode()) - (1 << 63)


def pieces(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, bool]]:
    """(start, end, inside) of all words in order, cut at the edges of entities; ``inside`` are parts of an entity."""
    out, upto = [], 0
    for s, e in [*sorted((s, e) for _, s, e in found), (len(text), len(text))]:
        out += [(*m.span(), False) for m in _WORD.finditer(text, upto, max(s, upto))]
        out += [(*m.span(), True) for m in _WORD.finditer(text, max(s, upto), max(e, upto))]
        upto = max(upto, e)
    return out


def contexts(text: str, found: list[tuple[int, int, int]], reach: int) -> tuple[set[tuple[int, int]], set[int]]:
    """(entity, term) of the terms near each entity, outside all entities; and the terms that stand only in words cut by an entity."""
    words = pieces(text, found)
    terms = ["" if inside else term_of(text[a:b]) for a, b, inside in words]
    starts, ends = [a for a, _, _ in words], [b for _, b, _ in words]
    near = set()
    for kind, s, e in found:
        left, right = bisect_right(ends, s), bisect_left(starts, e)
        entity = _entity(text, kind, s, e)
        near.update((entity, _term_hash(t)) for t in (*terms[max(0, left - reach):left], *terms[right:right + reach]) if t)
    whole = {term_of(w) for w in set(text.split())}
    return near, {_term_hash(t) for t in set(terms) - whole if t}


def _beside(rows: DataFrame, reach: int) -> DataFrame:
    """``id``, ``near``, the pairs of entities and terms beside them, and ``cut``, terms that no whole word of the text gives."""
    near = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            beside, cut = [], []
            for text in batch.column("text"):
                value = text.as_py()
                found = entities(value)
                pairs, others = contexts(value, found, reach) if found else ((), ())
                beside.append([{"entity": e, "term": t} for e, t in pairs])
                cut.append(list(others))
            yield pa.RecordBatch.from_arrays([pa.array(beside, near), pa.array(cut, pa.list_(pa.int64()))], ["near", "cut"])

    return rows.select("text").mapInArrow(run, "near array<struct<entity:bigint,term:bigint>>, cut array<bigint>").withColumn(
        "id", F.monotonically_increasing_id())


def _held(rows: DataFrame, marks: tuple[bytes, bytes], policy: Policy) -> DataFrame:
    """``id``, ``doc_id``, ``base`` (kind, start, end), ``entities`` and ``terms`` (term, start, end): all that the marks let through.

    ``marks`` have a bit for each disclosing term, and for each of those that are removed everywhere.
    """
    id_type = rows.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    held = pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[dict[str, int]] = [{}, {}]  # word -> its term where marked, else 0

        def marked(words: Iterable[str], which: int) -> dict[str, int]:
            seen = known[which]
            if len(seen) > policy.counted:
                seen.clear()
            for w in words:
                if w not in seen:
                    h = _term_hash(t) if (t := term_of(w)) else 0
                    at = h & ((1 << policy.marks) - 1)
                    seen[w] = h if t and marks[which][at >> 3] >> (at & 7) & 1 else 0
            return seen

        def occurrences(text: str, found: list[tuple[int, int, int]]) -> Iterator[dict[str, int]]:
            if not found and not any(map(marked(words := set(text.split()), 1).get, words)):
                return
            spots = [(a, b) for a, b, inside in pieces(text, found) if not inside]
            terms = marked({text[a:b] for a, b in spots}, 0 if found else 1)
            for a, b in spots:
                if term := terms[text[a:b]]:
                    first, last = _bare(text[a:b])
                    yield {"term": term, "start": a + first, "end": a + last}

        for batch in batches:
            base, of, terms = [], [], []
            for text in batch.column("text"):
                value = text.as_py()
                found = sorted(entities(value))
                base.append([dict(zip(("kind", "start", "end"), f)) for f in found])
                of.append(list({_entity(value, *f) for f in found}))
                terms.append(list(occurrences(value, found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, span), pa.array(of, pa.list_(pa.int64())), pa.array(terms, held)],
                ["doc_id", "base", "entities", "terms"])

    return rows.mapInArrow(
        run, f"doc_id {id_type}, base array<struct<kind:int,start:bigint,end:bigint>>, entities array<bigint>, "
        "terms array<struct<term:bigint,start:bigint,end:bigint>>").withColumn("id", F.monotonically_increasing_id())


def document_counts(rows: DataFrame, limit: int) -> DataFrame:
    """``term`` and ``n``: in how many documents of the corpus each term occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        counts: Counter[str] = Counter()

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([_term_hash(t) for t in counts], pa.int64()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                words = set(text.as_py().split())
                for w in words.difference(known):
                    known[w] = term_of(w)
                counts.update({known[w] for w in words} - {""})
                if len(counts) > limit:
                    yield passed_on()
                if len(known) > limit:
                    known.clear()
        if counts:
            yield passed_on()

    return rows.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def disclosures(found: DataFrame, rows: DataFrame, policy: Policy) -> DataFrame:
    """``entity``, ``term`` and ``disclosure`` of every pair at or above the lower threshold."""
    total = found.count()
    pairs = found.select("id", F.explode_outer(F.array_distinct(F.transform("near", lambda x: F.struct(x["entity"].alias("entity"), x["term"].alias("term"))))).alias("p"))
    both = pairs.where("p is not null").groupBy("p.entity", "p.term").agg(F.count(F.lit(1)).alias("n_te")).where(F.col("n_te") >= policy.support)
    alone = found.select(F.explode_outer(F.array_distinct(F.transform("near", lambda x: x["entity"]))).alias("of")).where(
        "of is not null").groupBy("of").agg(F.count(F.lit(1)).alias("n_e"))
    counts = document_counts(rows, policy.counted).unionByName(
        found.select(F.explode("cut").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))).groupBy(
        F.col("term").alias("word")).agg(F.sum("n").alias("n_t"))
    known = both.join(alone, F.col("entity") == F.col("of")).join(counts, F.col("term") == F.col("word"))
    about = F.log2(F.lit(float(total)) * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    own = F.log2(F.lit(float(total)) / F.col("n_e"))
    return known.where("n_e < " + str(total)).select("entity", "term", (about / own).alias("disclosure")).where(F.col("disclosure") >= policy.general)


def _marks(strong: DataFrame, policy: Policy) -> tuple[bytes, bytes]:
    """Bits by the low end of a term's hash, of all terms and of those to remove; the size is the same for any number of terms."""
    low = F.col("term").bitwiseAND(F.lit((1 << policy.marks) - 1))
    bit = F.expr("shiftleft(1L, cast(term & 63 as int))")
    rows = strong.groupBy(F.shiftright(low, 6).alias("at")).agg(
        F.bit_or(bit).alias("all"), F.bit_or(F.when(F.col("disclosure") >= policy.remove, bit).otherwise(F.lit(0).cast("long"))).alias("removed")).toArrow()
    out = []
    for name in ("all", "removed"):
        bits = np.zeros(1 << (policy.marks - 6), "<i8")
        bits[rows.column("at").to_numpy()] = rows.column(name).to_numpy()
        out.append(bits.tobytes())
    return out[0], out[1]


def _judged(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``found``: base spans and the terms that ``told`` has as disclosing an entity of the document, or as removed."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    general, removed = KINDS.index("general"), KINDS.index("removed")
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for base, entities_, terms, told in zip(*[batch.column(c).to_pylist() for c in ("base", "entities", "terms", "told")]):
                of, kinds = set(entities_), {}
                for t in told or ():
                    reached = [p["kind"] for p in t["pairs"] if p["kind"] == removed or p["entity"] in of]
                    kinds[t["term"]] = max(reached, default=0)
                extra = [{"kind": k, "start": t["start"], "end": t["end"]} for t in terms if (k := kinds.get(t["term"], 0)) >= general]
                found.append(base + sorted(extra, key=lambda x: (x["kind"], x["start"])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("base"), pa.array(found, span)], ["doc_id", "base", "found"])

    spans = "array<struct<kind:int,start:bigint,end:bigint>>"
    return rows.select("doc_id", "base", "entities", "terms", "told").mapInArrow(run, f"doc_id {id_type}, base {spans}, found {spans}")


def scan(docs: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """``doc_id``, counts per base kind, ``base_sha256``, ``spans``, ``n_terms`` and ``found``, all spans as structs.

    Places count code points, ends are exclusive; spans come by kind as listed, then start. A null text
    counts as empty and has no spans. Repeated rows each get their row and count as documents of their own;
    extra columns are left out; an empty table gives an empty result. A row without an id is judged like any other.
    """
    rows = texts(docs)
    strong = settled(disclosures(settled(_beside(rows, policy.reach)), rows, policy))
    held = settled(_held(rows, _marks(strong, policy), policy))
    # A term discloses few entities, as it must be met mostly beside each of them.
    kind = F.when(F.col("disclosure") >= policy.remove, KINDS.index("removed")).otherwise(KINDS.index("general"))
    pairs = strong.groupBy(F.col("term").alias("t")).agg(F.collect_list(F.struct("entity", kind.alias("kind"))).alias("pairs"))
    asked = held.select("id", F.explode(F.array_distinct(F.transform("terms", lambda x: x["term"]))).alias("term"))
    told = asked.join(pairs, F.col("term") == F.col("t")).groupBy(F.col("id").alias("of")).agg(F.collect_list(F.struct("term", "pairs")).alias("told"))
    all_ = _judged(held.join(told, F.col("id") == F.col("of"), "left"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(BASE)]
    return all_.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("found").alias("spans"),
                       (F.size("found") - F.size("base")).cast("long").alias("n_terms"), "found")


def _listed(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def sanitised(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with entities and terms replaced by their general form, removed terms by nothing."""
    out, upto = [], 0
    for kind, start, end in sorted(found, key=lambda f: (f[1], -f[2])):
        if start >= upto:
            word = "" if KINDS[kind] == "removed" else "[NAME]" if KINDS[kind] == "general" and text[start].isupper() else (
                "[WORD]" if KINDS[kind] == "general" else f"[{KINDS[kind].upper()}]")
            out += [text[upto:start], word]
        upto = max(upto, end)
    return "".join([*out, text[upto:]])

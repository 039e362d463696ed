"""Document fingerprints by invertible Bloom lookup sketches.

A text is cut into paragraphs: lines, and lines longer than ``PIECE`` characters into parts. A sketch
has three tables of cells; each paragraph digest is added to one cell of each, as a count and an XOR of
digests. A digest is 48 bits of hash and 16 bits of a hash of these, so a cell knows whether it holds one
digest alone. The tables' width is a power of two that follows the number of paragraphs, and grows until the
sketch gives back its own digests; cells are kept as the sorted list of those in use.

Sketches of two versions are subtracted cell by cell, which leaves the digests that differ. They may be of
different widths: a wide one folds to the narrow one's width, as its cells' hashes do. A cell with one digest
gives it away; taking it out of its other cells opens the next ones, until nothing is left. This is tried
at the narrow width first. If it gets stuck, the next size takes part: each sketch is peeled at its own
width, which lists all its digests, and these are compared. What a text's sketch cannot give is taken from its
digests themselves. All of it is column expressions within a row; no user function runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.common import let, texts

#: Code points of a part of a line at most; cells in each of the three tables of the smallest sketch.
PIECE, WIDTH = 200, 4
#: Cells for each digest at least, widths tried for a sketch, and rounds of peeling.
ROOM, TRIES, ROUNDS = 2.0, 6, 24


def digests(text: Column) -> Column:
    """One digest for each different paragraph, of its text and how often it occurs."""
    paragraphs = F.regexp_extract_all(text, F.lit(f"(?s)[^\\n]{{1,{PIECE}}}\\n*|\\n+"), F.lit(0))
    return let(F.sort_array(F.transform(paragraphs, lambda p: F.xxhash64(p))), lambda s: let(
        _run_starts(s, lambda x: x), lambda b: F.transform(
            b, lambda at, k: let(F.shiftrightunsigned(F.xxhash64(F.get(s, at), F.coalesce(F.get(b, k + 1), F.size(s)) - at), 16), _checked))))


def _checked(bits: Column) -> Column:
    return F.shiftleft(bits, 16).bitwiseOR(F.xxhash64(bits).bitwiseAND(F.lit(0xFFFF)))


def _run_starts(items: Column, key: Callable[[Column], Column]) -> Column:
    """Places where a sorted array has a new key."""
    return F.filter(F.transform(items, lambda x, i: i), lambda i: (i == 0) | (key(F.get(items, i)) != key(F.get(items, i - 1))))


def _cells_of(digest: Column, count: Column, width: Column) -> Column:
    """A digest's cell in each table."""
    return F.array(*[F.struct(
        (F.lit(t).cast("long") * width + F.pmod(F.xxhash64(digest, F.lit(t)), width)).alias("at"),
        count.cast("long").alias("count"), digest.alias("digests")) for t in range(3)])


def _summed(cells: Column) -> Column:
    """Cells at one place added up; those that become empty go."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("count"), F.lit(0).cast("long").alias("digests"))

    def add(a: Column, c: Column) -> Column:
        return F.struct(c["at"].alias("at"), (a["count"] + c["count"]).alias("count"), a["digests"].bitwiseXOR(c["digests"]).alias("digests"))

    # Places instead of slices: a slice would copy the whole array each time.
    return let(F.sort_array(cells), lambda s: let(_run_starts(s, lambda c: c["at"]), lambda b: F.filter(
        F.transform(b, lambda at, k: F.aggregate(
            F.sequence(at, F.coalesce(F.get(b, k + 1), F.size(s)) - 1), zero, lambda a, i: add(a, F.get(s, i)))),
        lambda c: (c["count"] != 0) | (c["digests"] != 0))))


def _added(keys: Column, sign: int, width: Column) -> Column:
    return F.flatten(F.transform(keys, lambda d: _cells_of(d, F.lit(sign), width)))


def sketch(keys: Column) -> Column:
    """``width``, ``n`` (digests) and ``cells``, those in use, of the sketch of ``keys``.

    A sketch that does not give its digests back is made again with tables twice as wide.
    """
    kind = "struct<width:bigint,n:int,cells:array<struct<at:bigint,count:bigint,digests:bigint>>>"
    least = F.ceil(F.log2(F.size(keys) * (ROOM / (3 * WIDTH)) + 1))

    def one(k: Column) -> Column:
        width = (F.pow(F.lit(2.0), least + k) * WIDTH).cast("long")
        made = let(width, lambda w: F.struct(w.alias("width"), F.size(keys).alias("n"), _summed(_added(keys, 1, w)).alias("cells")))
        return let(made, lambda s: F.when((k == TRIES - 1) | peeled(s["cells"], s["width"]).isNotNull(), s))

    return F.aggregate(F.sequence(F.lit(0), F.lit(TRIES - 1)), F.lit(None).cast(kind), lambda got, k: F.when(got.isNotNull(), got).otherwise(one(k)))


def _folded(sketch_: Column, sign: int, width: Column) -> Column:
    """The cells of a sketch at a width that divides its own, still to be summed."""
    return F.transform(sketch_["cells"], lambda c: F.struct(
        (F.floor(c["at"] / sketch_["width"]) * width + F.pmod(F.pmod(c["at"], sketch_["width"]), width)).cast("long").alias("at"),
        (c["count"] * sign).alias("count"), c["digests"].alias("digests")))


def subtracted(a: Column, b: Column, width: Column) -> Column:
    """The cells of the sketch a minus the sketch b, both folded to ``width``."""
    return _summed(F.concat(_folded(a, 1, width), _folded(b, -1, width)))


def peeled(cells: Column, width: Column) -> Column:
    """Arrays ``more`` and ``less`` of the digests left with either sign, or null when it gets stuck."""
    start = F.struct(cells.alias("cells"), F.array().cast("array<bigint>").alias("more"), F.array().cast("array<bigint>").alias("less"), F.lit(True).alias("open"))

    def single(state: Column, sign: int) -> Column:
        return F.array_distinct(F.transform(F.filter(state["cells"], lambda c: (c["count"] == sign) & (
            _checked(F.shiftrightunsigned(c["digests"], 16)) == c["digests"])), lambda c: c["digests"]))

    def step(state: Column) -> Column:
        met = F.struct(single(state, 1).alias("more"), single(state, -1).alias("less"))
        return let(met, lambda m: F.when(F.size(m["more"]) + F.size(m["less"]) == 0, F.struct(
            state["cells"].alias("cells"), state["more"].alias("more"), state["less"].alias("less"), F.lit(False).alias("open"))).otherwise(F.struct(
                _summed(F.concat(state["cells"], _added(m["more"], -1, width), _added(m["less"], 1, width))).alias("cells"),
                F.concat(state["more"], m["more"]).alias("more"), F.concat(state["less"], m["less"]).alias("less"), F.lit(True).alias("open"))))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda state, _: F.when(
        (F.size(state["cells"]) == 0) | ~state["open"], state).otherwise(step(state)))
    # A digest with either sign was read off a cell by mistake and put back.
    return let(done, lambda d: F.when(F.size(d["cells"]) == 0, F.struct(
        F.array_except(d["more"], d["less"]).alias("more"), F.array_except(d["less"], d["more"]).alias("less"))))


def difference(a: Column, b: Column) -> Column:
    """Digests of a but not b (``more``) and of b but not a (``less``), recovered from their sketches; null
    where neither their difference nor both by themselves can be peeled."""
    def listed(both: Column) -> Column:
        return let(F.transform(both, lambda s: peeled(s["cells"], s["width"])["more"]), lambda m: F.when(
            m[0].isNotNull() & m[1].isNotNull(), F.struct(F.array_except(m[0], m[1]).alias("more"), F.array_except(m[1], m[0]).alias("less"))))

    small = let(F.least(a["width"], b["width"]), lambda w: peeled(subtracted(a, b, w), w))
    return let(small, lambda got: F.when(got.isNotNull(), got).otherwise(listed(F.array(a, b))))


def likeness(a: Column, b: Column, keys_a: Column, keys_b: Column) -> Column:
    """One minus the share of digests that differ, by the sketches; two empty texts are alike.

    The digests themselves count only where the sketches do not give the difference.
    """
    total = a["n"] + b["n"]
    differ = let(difference(a, b), lambda d: F.when(d.isNotNull(), F.size(d["more"]) + F.size(d["less"])).otherwise(
        F.size(F.array_except(keys_a, keys_b)) + F.size(F.array_except(keys_b, keys_a))))
    return F.when(total == 0, F.lit(1.0)).otherwise(1.0 - differ / total)


def written(sketch_: Column) -> Column:
    """A sketch as text: digests and width, then its cells in use, each with place, count and digests."""
    return F.concat_ws(" ", F.concat_ws("/", sketch_["n"].cast("string"), sketch_["width"].cast("string")), F.array_join(F.transform(sketch_["cells"], lambda c: F.concat_ws(
        ":", F.hex(c["at"]), c["count"].cast("string"), F.lower(F.hex(c["digests"])))), " "))


def read(text: Column) -> Column:
    """The sketch that ``written`` made a text of."""
    parts, head = F.split(text, " "), F.split(F.split(text, " ")[0], "/")
    number = lambda h: F.conv(h, 16, -10).cast("long")
    cells = F.transform(F.filter(F.slice(parts, F.lit(2), F.size(parts)), lambda c: c != ""), lambda c: let(F.split(c, ":"), lambda x: F.struct(
        number(x[0]).alias("at"), x[1].cast("long").alias("count"), number(x[2]).alias("digests"))))
    return F.struct(head[1].cast("long").alias("width"), head[0].cast("int").alias("n"), cells.alias("cells"))


def followed(docs: DataFrame, buckets: int) -> DataFrame:
    """``doc_id``, ``text`` and ``next``, the text of the row after it by id; after the last the first.

    Ids are cut at quantiles into buckets, which are sorted on their own, so no task sees all rows.
    Each bucket's first row is also dealt, as a guest, to the bucket before. Rows with one id
    follow each other by a hash of their text; null ids come first.
    """
    rows = texts(docs).withColumn("order", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType
    if isinstance(kind, T.NumericType):
        cuts = rows.agg(F.percentile_approx("doc_id", [k / buckets for k in range(1, buckets)], 100 * buckets)).first()[0] or []
    else:
        # Of ids without arithmetic a bounded sample is sorted: it only says where buckets begin.
        part = -(-rows.count() // (100 * buckets)) or 1
        sample = sorted(r[0] for r in rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(part)) == 0).select("doc_id").distinct().collect() if r[0] is not None)
        cuts = [sample[k * len(sample) // buckets] for k in range(1, buckets)] if sample else []
    bounds = F.array(*[F.lit(c).cast(kind) for c in sorted(set(cuts))]) if cuts else F.array().cast(T.ArrayType(kind))
    dealt = rows.withColumn("bucket", F.coalesce(F.size(F.filter(bounds, lambda c: c < F.col("doc_id"))), F.lit(0)))
    # One row for each bucket, at most ``buckets``: small enough to broadcast.
    all_ = Window.orderBy("of")
    firsts = dealt.groupBy(F.col("bucket").alias("of")).agg(F.min(F.struct("doc_id", "order")).alias("first")).select(
        "of", "first", F.coalesce(F.lag("of").over(all_), F.max("of").over(Window.orderBy(F.lit(0)))).alias("before"))
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("order") == F.col("first.order"))
    there = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("guest"))
    placed = dealt.join(F.broadcast(firsts), F.col("bucket") == F.col("of")).select(
        "doc_id", "text", "order", F.explode(F.when(is_first, F.array(here, there)).otherwise(F.array(here))).alias("place"))
    along = Window.partitionBy("place.bucket").orderBy("place.guest", F.col("doc_id").asc_nulls_first(), "order")
    return placed.withColumn("next", F.lead("text").over(along)).where("not place.guest").select("doc_id", "text", "next")


def versions(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of each text, and likeness to its edited text and to the next document.

    ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``. The edited text has its last half, rounded down, replaced by as much of the start of the next
    document. A null text counts as empty. Repeated rows each get their row, and follow each other; a row
    alone follows itself. Extra columns are left out, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    pairs = followed(docs, buckets or min(2000, max(2, 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next"), F.lit(1), half))
    cut = pairs.select("doc_id", n.cast("long").alias("n_chars"), "text", "next", edited.alias("edited"))
    # Of the text, the edited text and the next text; each expression stands once in the plan.
    keyed = cut.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.transform(
        F.array("text", "edited", "next"), lambda t: let(digests(t), lambda k: F.struct(k.alias("keys"), sketch(k).alias("sketch")))).alias("three"))
    one = F.col("three")[0]
    return keyed.select(
        "doc_id", "n_chars", "edited_sha256", F.transform(F.slice("three", 1, 2), lambda x: written(x["sketch"])).alias("texts"),
        F.transform(F.slice("three", 2, 2), lambda x: likeness(one["sketch"], x["sketch"], one["keys"], x["keys"])).alias("near")).select(
        "doc_id", "n_chars", "edited_sha256", F.col("texts")[0].alias("fingerprint"), F.col("texts")[1].alias("edited_fingerprint"),
        F.col("near")[0].alias("near_edited"), F.col("near")[1].alias("near_next"))

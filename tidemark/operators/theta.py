"""Joins on an inequality that return their rows.

Both sides are cut at the same equi-depth points into bands. A row of the smaller side matches every row of
the bands above its own without looking, so these pairs are an equi-join on the band, as large as its
result. Only inside a band are values compared: there both sides are sorted and merged. An interval
that ends up as one value alone is a band of its own, so a value that very many rows share
is never compared with itself.

The result may be far larger than the input, so pairs come out in an order that files store well: band by
band, and in a band the same short run of one side again for each row of the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.columns import micros

#: Pairs given back at once by a merge.
PAIRS = 1 << 16
#: Pairs of whole bands that a task should make, where there are bands enough.
TASK = 1 << 24


def _number(value: Column, kind: T.DataType) -> Column:
    """A double that never falls where the value rises."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return micros(value, kind).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    raise TypeError(f"no order of bands for values of type {kind.simpleString()}")


def _tells_apart(kind: T.DataType, value: float) -> bool:
    """Does the double stand for one value alone?"""
    return abs(value) < 1 << 53 and not (isinstance(kind, T.DecimalType) and kind.precision > 15)


def theta_join(left: DataFrame, sign: str, right: DataFrame, left_on: str, right_on: str, bands: int = 1024) -> DataFrame:
    """Pairs of rows for which ``left_on sign right_on``, with the columns of both; ``sign`` is <, <=, > or >=.

    Null and NaN match nothing; repeated rows each match. The two sides have no column name in
    common. The result is the same for any number of ``bands``: a band's rows are merged by one task.
    """
    if sign not in ("<", "<=", ">", ">="):
        raise ValueError(f"no inequality: {sign}")
    if clash := set(left.columns) & set(right.columns):
        raise ValueError(f"both sides have columns {sorted(clash)}")
    names = [*left.columns, *right.columns]
    if sign[0] == ">":
        left, right, left_on, right_on = right, left, right_on, left_on
    strict = len(sign) == 1
    kind = left.select(F.col(left_on).alias("x")).union(right.select(F.col(right_on).alias("x"))).schema["x"].dataType

    def keyed(side: DataFrame, on: str) -> DataFrame:
        rows = side.withColumn("_x", F.col(on).cast(kind)).withColumn("_k", _number(F.col("_x"), kind))
        return rows.where(F.col("_k").isNotNull() & ~F.isnan("_k"))

    small, large = keyed(left, left_on), keyed(right, right_on)
    # What lies beyond the other side's range matches nothing, or leaves before anything is shuffled.
    least, most = small.agg(F.min("_k")).first()[0], large.agg(F.max("_k")).first()[0]
    out = T.StructType([f for c in names for f in [*left.schema.fields, *right.schema.fields] if f.name == c])
    if least is None or most is None or least > most:
        return left.sparkSession.createDataFrame([], out)
    small, large = small.where(F.col("_k") <= most), large.where(F.col("_k") >= least)
    edges, alone = _edges(small.select("_k").union(large.select("_k")), bands)
    split = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol="_k", outputCol="_b") if edges else None

    def banded(side: DataFrame) -> DataFrame:
        return (split.transform(side) if split else side.withColumn("_b", F.lit(0.0))).withColumn("_b", F.col("_b").cast("int"))

    small, large = banded(small), banded(large)
    # One row a band, whatever the tables hold.
    count = len(edges) + 1
    n_small, n_large = np.zeros(count), np.zeros(count)
    for side, into in ((small, n_small), (large, n_large)):
        for r in side.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect():
            into[r["_b"]] = r["n"]
    equal = np.array([k in alone and _tells_apart(kind, edges[k - 1]) for k in range(count)])  # bands of one value
    whole = equal & (not strict)

    # Bands whose rows match as a whole: those above, and a band of one value where equal ones count. Copy the
    # side that has fewer rows to copy.
    k = np.arange(count)
    above = np.cumsum((n_large > 0)[::-1])[::-1] - (n_large > 0) + (whole & (n_large > 0))
    below = np.cumsum(n_small > 0) - (n_small > 0) + (whole & (n_small > 0))
    total = (n_large * (np.cumsum(n_small) - n_small * ~whole)).sum()
    if (n_small * above).sum() <= (n_large * below).sum():
        met = k[n_large > 0]
        since = np.searchsorted(met, k + ~whole)
        copies, rest = _copied(small, met, since, np.full(count, len(met)) - since), large
    else:
        met = k[n_small > 0]
        until = np.searchsorted(met, k + whole)
        copies, rest = _copied(large, met, np.zeros(count, int), until), small
    # A merge join goes through the copies and gives the rows of a band for each; a hash join would mix the bands. The
    # number of tasks follows the pairs: the sizes of the two sides tell nothing of them.
    keep = [F.col(f"`{c}`") for c in names]
    extra = ["_x", "_k", "_b"]
    tasks = max(1, min(len(met), math.ceil(total / TASK)))
    dealt = [side.drop(*extra).repartition(tasks, "_to") for side in (copies, rest.withColumn("_to", F.col("_b")))]
    far = dealt[0].hint("merge").join(dealt[1], "_to").select(*keep)

    near = (n_small > 0) & (n_large > 0) & ~equal
    if not near.any():
        return far
    listed = F.lit([bool(x) for x in near])
    schemas = {"_small": left.schema, "_large": right.schema}
    sides = [
        side.where(F.element_at(listed, F.col("_b") + 1)).select("_b", "_x", *[
            (F.struct(*[F.col(f"`{c}`") for c in schema.names]) if name == mine else F.lit(None).cast(schema)).alias(name)
            for name, schema in schemas.items()])
        for side, mine in ((small, "_small"), (large, "_large"))]
    pairs = T.StructType([T.StructField(name, schema) for name, schema in schemas.items()])
    merged = sides[0].unionByName(sides[1]).repartition("_b").sortWithinPartitions("_b").mapInArrow(_merger(strict), pairs)
    return far.unionByName(merged.select("_small.*", "_large.*").select(*keep))


def _edges(keys: DataFrame, bands: int) -> tuple[list[float], set[int]]:
    """Ascending edges of bands, and the numbers of the bands that hold one double alone."""
    grid = [k / bands for k in range(1, bands)]
    points = keys.agg(F.percentile_approx("_k", grid, 20 * bands)).first()[0] if grid else []
    edges: list[float] = []
    alone: set[int] = set()
    for value, following in zip(points, [*points[1:], None]):
        if edges and value < edges[-1] or not math.isfinite(value):
            continue
        if not edges or value > edges[-1]:
            edges.append(value)
        if value == following and (not alone or len(edges) not in alone):  # a value met at two points
            alone.add(len(edges))
            edges.append(math.nextafter(value, math.inf))
    return edges, alone


def _copied(side: DataFrame, met: np.ndarray, start: np.ndarray, length: np.ndarray) -> DataFrame:
    """Each row once for each of its bands: a run of ``met`` that depends on the row's own band."""
    at = lambda values: F.element_at(F.lit([int(v) for v in values]), F.col("_b") + 1)
    return side.withColumn("_to", F.explode(F.slice(F.lit([int(v) for v in met]), at(start) + 1, at(length))))


def _merger(strict: bool):
    """Function for ``mapInArrow``: rows of both sides sorted by band -> pairs with a smaller and a larger value."""

    def merge(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        values = rows.column("_x").combine_chunks()
        by = pc.sort_indices(values).to_numpy()
        ordered = values.take(pa.array(by))
        rank = np.zeros(len(by), np.int64)
        if len(by) > 1:
            rank[by[1:]] = np.cumsum(pc.not_equal(ordered[1:], ordered[:-1]).to_numpy(zero_copy_only=False))
        is_small = rows.column("_small").combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        small, large = np.nonzero(is_small)[0], np.nonzero(~is_small)[0]
        large = large[np.argsort(rank[large], kind="stable")]
        since = np.searchsorted(rank[large], rank[small], side="right" if strict else "left")
        counts = len(large) - since
        tops = np.cumsum(counts)
        for at in range(0, int(tops[-1]) if len(tops) else 0, PAIRS):
            pair = np.arange(at, min(at + PAIRS, int(tops[-1])))
            row = np.searchsorted(tops, pair, side="right")
            other = large[since[row] + pair - (tops - counts)[row]]
            yield pa.RecordBatch.from_arrays(
                [rows.column("_small").take(pa.array(small[row])).combine_chunks(), rows.column("_large").take(pa.array(other)).combine_chunks()],
                ["_small", "_large"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            band = batch.column("_b").to_numpy()
            cuts = [0, *(np.nonzero(np.diff(band))[0] + 1).tolist(), len(band)]
            for lo, hi in zip(cuts, cuts[1:]):
                if held and held[-1].column("_b")[0].as_py() != band[lo]:
                    yield from merge(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from merge(pa.Table.from_batches(held))

    return run

"""Splitting ids that hold too many writes for one task.

Resolving an id means looking at its writes in valid-time order, so a plain plan
puts all writes of an id in one task.  That is fine for ordinary ids and breaks
for an id holding a large share of the table.  ``profile`` counts writes per id
and lists those above a limit; ``cut_points`` places equi-depth cuts in the
timelines of just those ids.

What reaches the driver is bounded whatever the data: at most ``rows / limit``
hot ids and a few cuts per ``limit`` rows of them, with ``limit`` at least
``rows / MAX_HOT``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import ID, VALID_FROM, VALID_TO

ROWS_PER_TASK = 1_000_000
MAX_HOT = 50_000


@dataclass(frozen=True)
class KeyProfile:
    limit: int
    hot: dict = field(default_factory=dict)  # id -> number of writes

    def hot_frame(self, log: DataFrame) -> DataFrame:
        rows = [(key,) for key in self.hot]
        return log.sparkSession.createDataFrame(rows, log.select(ID).schema)

    def merged(self, *others: KeyProfile) -> KeyProfile:
        """Profile of several sets of writes together.

        An id hot in none of them has at most ``limit`` writes in each, so what one
        task may meet grows with the number of sets only.
        """
        hot = dict(self.hot)
        for other in others:
            for key, n in other.hot.items():
                hot[key] = hot.get(key, 0) + n
        return KeyProfile(max(self.limit, *(o.limit for o in others)) if others else self.limit, hot)

    def cold(self, log: DataFrame) -> DataFrame:
        if not self.hot:
            return log
        return log.join(F.broadcast(self.hot_frame(log)), ID, "left_anti")

    def heated(self, log: DataFrame) -> DataFrame:
        return log.join(F.broadcast(self.hot_frame(log)), ID, "left_semi")


def profile(log: DataFrame, limit: int | None = None) -> KeyProfile:
    """Find ids with more writes than one task should take.

    A log no longer than the limit cannot hold a hot id, so small tables pay for a
    row count only (answered from file footers on a plain Parquet scan).
    """
    rows = log.count()
    if limit is None:
        limit = max(ROWS_PER_TASK, rows // MAX_HOT)
    if rows <= limit:
        return KeyProfile(limit)
    counts = log.groupBy(ID).agg(F.count("*").alias("n")).where(F.col("n") > limit)
    return KeyProfile(limit, {r[ID]: r["n"] for r in counts.collect()})


def cut_points(hot_log: DataFrame, prof: KeyProfile) -> dict:
    """Equi-depth cuts per hot id, as sorted epoch-microsecond arrays.

    Cuts are taken over both ends of every period.  An instant shared by very many
    writes comes back as several equal quantiles and so becomes a cut itself, which
    keeps the writes starting or ending there out of any chunk's interior.
    Ids are handled in classes of similar size so one quantile grid fits a class.
    """
    classes: dict[int, list] = {}
    for key, n in prof.hot.items():
        classes.setdefault(max(n // prof.limit, 1).bit_length(), []).append(key)
    cuts = {}
    for size_class, keys in classes.items():
        parts = 2 ** (size_class + 2)
        grid = [i / parts for i in range(1, parts)]
        wanted = KeyProfile(prof.limit, dict.fromkeys(keys, 0)).heated(hot_log)
        points = wanted.select(ID, F.explode(F.array(VALID_FROM, VALID_TO)).alias("_point"))
        quantiles = points.where(F.col("_point").isNotNull()).groupBy(ID).agg(
            F.percentile_approx("_point", grid, max(10_000, 4 * parts)).alias("_cuts")
        )
        table = quantiles.toArrow()
        for key, values in zip(table[ID].to_pylist(), table["_cuts"]):
            cuts[key] = np.unique(values.values.cast("int64").to_numpy())
    return cuts

"""Arrow-batch helpers of the resolution plans: versions of bounded writes and the cutting of periods.

Both run inside ``mapInArrow`` on narrow rows (no payload), whole columns at a time.  Instants are handled
as epoch microseconds; an open end is the largest 64-bit integer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.columns import ID, SEQ, TX, VALID_FROM, VALID_TO

OPEN = np.iinfo(np.int64).max


def _instants(column) -> np.ndarray:
    return column.cast("int64").fill_null(OPEN).to_numpy(zero_copy_only=False)


def _instant_array(values, arrow_type) -> pa.Array:
    ints = np.asarray(values, dtype=np.int64)
    return pa.array(ints, mask=ints == OPEN).cast(arrow_type)


#: Rows resolved together, but for a group that has more. What a worker holds follows from this, not from its task.
BATCH = 1 << 15


def resolver(columns: list[str], group: list[str]):
    """Function for ``mapInArrow``: narrow rows, those of a group together -> the versions of each group.

    A version has the columns of the write that wins it with its own period, and ``_w``, that write's place among
    the rows of its group; ``_edge`` marks the first and last version of a group, and ``_bounded`` groups with a write that ends.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= BATCH:
                rows = pa.Table.from_batches(held).combine_chunks()
                starts = _group_starts(rows, group)
                if starts[-1]:
                    yield from _resolved(rows.slice(0, int(starts[-1])), starts[:-1], columns)
                rest = rows.slice(int(starts[-1]))
                # A copy, so that what is done with can be freed.
                held, size = rest.take(pa.array(np.arange(rest.num_rows))).to_batches(), rest.num_rows
        if size:
            rows = pa.Table.from_batches(held).combine_chunks()
            yield from _resolved(rows, _group_starts(rows, group), columns)

    return run


def _group_starts(rows: pa.Table, group: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for name in group:
        codes = rows.column(name).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.nonzero(new)[0]


def winners(group: np.ndarray, start: np.ndarray, end: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, ...]:
    """Periods and the writes that win them: of those of a group that cover an instant, the greatest by ``order``.

    The starts and ends of all groups, in order, cut time into elementary intervals, the leaves of a binary
    tree. A write covers a run of leaves, which is the union of two nodes a level at most. A node keeps its
    greatest write; the winner of a leaf is the greatest among its ancestors'. Returns group, start, end and
    order of each version; neighbouring leaves with one winner are one.
    """
    bounded = end != OPEN
    g, p = np.concatenate([group, group[bounded]]), np.concatenate([start, end[bounded]])
    by = np.lexsort((p, g))
    new = np.ones(len(by), bool)
    new[1:] = (g[by[1:]] != g[by[:-1]]) | (p[by[1:]] != p[by[:-1]])
    leaf = np.empty(len(by), np.int64)
    leaf[by] = np.cumsum(new) - 1
    at, point = g[by[new]], p[by[new]]
    a, b = leaf[:len(group)], np.searchsorted(at, group, side="right")
    b[bounded] = leaf[len(group):]

    n = len(at)
    levels: list[np.ndarray] = []
    lo, hi, write = a.copy(), b.copy(), order.copy()
    while len(lo):
        best = np.full(-(-n >> len(levels)) + 1, -1, np.int64)
        left, right = (lo & 1).astype(bool), (hi & 1).astype(bool)
        np.maximum.at(best, lo[left], write[left])
        np.maximum.at(best, hi[right] - 1, write[right])
        levels.append(best)
        lo, hi = (lo + 1) >> 1, hi >> 1
        on = lo < hi
        lo, hi, write = lo[on], hi[on], write[on]
    won = np.full(1, -1, np.int64)
    for best in reversed(levels):
        won = np.maximum(np.repeat(won, 2)[:len(best)], best) if len(won) * 2 >= len(best) else np.maximum(
            np.concatenate([np.repeat(won, 2), np.full(len(best) - 2 * len(won), -1)]), best)
    won = won[:n]

    until = np.append(point[1:], OPEN)
    until[:-1][at[1:] != at[:-1]] = OPEN
    first = np.ones(n, bool)
    first[1:] = (at[1:] != at[:-1]) | (won[1:] != won[:-1])
    spot = np.nonzero(first)[0]
    last = np.append(spot[1:], n) - 1
    some = won[spot] >= 0
    return at[spot][some], point[spot][some], until[last][some], won[spot][some]


def _resolved(rows: pa.Table, starts: np.ndarray, columns: list[str]) -> Iterator[pa.RecordBatch]:
    n = rows.num_rows
    begins, ends = _instants(rows.column(VALID_FROM).combine_chunks()), _instants(rows.column(VALID_TO).combine_chunks())
    group = np.zeros(n, np.int64)
    group[starts[1:]] = 1
    group = np.cumsum(group)
    tx, seq = (rows.column(c).to_numpy() for c in (TX, SEQ))
    by = np.lexsort((np.arange(n), seq, tx))
    order = np.empty(n, np.int64)
    order[by] = np.arange(n)
    at, since, until, won = winners(group, begins, ends, order)
    write = by[won]
    ends_some = np.zeros(len(starts), bool)
    ends_some[group[ends != OPEN]] = True
    edge = np.ones(len(at), bool)
    edge[1:-1] = (at[1:-1] != at[:-2]) | (at[1:-1] != at[2:])
    out = rows.take(pa.array(write))
    time_type = rows.schema.field(VALID_FROM).type
    made = {c: out.column(c).combine_chunks() for c in columns} | {
        VALID_FROM: _instant_array(since, time_type), VALID_TO: _instant_array(until, time_type),
        "_w": pa.array((write - starts[at] + 1).astype(np.int32)), "_edge": pa.array(edge), "_bounded": pa.array(ends_some[at])}
    names = [*columns, "_w", "_edge", "_bounded"]
    yield pa.RecordBatch.from_arrays([made[c] for c in names], names)


def cutter(columns: list[str], cuts: dict, depth: int):
    """Function for ``mapInArrow``: cut each period at its id's cuts.

    A piece with ``_level`` -1 lies inside chunk ``_chunk``.  A piece with a level
    of 0 or more says the write covers every chunk under that tree node in full.
    """

    def run(batches):
        for batch in batches:
            data = dict(zip(columns, batch.columns))
            start, end = _instants(data[VALID_FROM]), _instants(data[VALID_TO])
            place = _place(data[ID].dictionary_encode(), start, end, cuts)
            pick, new_start, new_end, level, chunk = _pieces(start, end, place, depth)
            taken = batch.take(pa.array(pick))
            made = dict(zip(columns, taken.columns))
            time_type = data[VALID_FROM].type
            made[VALID_FROM] = _instant_array(new_start, time_type)
            made[VALID_TO] = _instant_array(new_end, time_type)
            made["_level"] = pa.array(level.astype(np.int32))
            made["_chunk"] = pa.array(chunk.astype(np.int32))
            names = [*columns, "_level", "_chunk"]
            yield pa.RecordBatch.from_arrays([made[n] for n in names], names)

    return run


def _place(ids, start, end, cuts) -> dict[str, np.ndarray]:
    """Where each period starts and ends among the cuts of its own id."""
    n = len(start)
    place = {name: np.empty(n, dtype=np.int64) for name in ("first", "final", "cut", "high", "last")}
    codes = ids.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    breaks = np.flatnonzero(np.diff(codes[order])) + 1
    for rows in np.split(order, breaks):
        bounds = cuts[ids.dictionary[int(codes[rows[0]])].as_py()]
        edges = np.append(bounds, OPEN)
        first = np.searchsorted(bounds, start[rows], side="right")
        final = np.where(
            end[rows] == OPEN, len(edges), np.searchsorted(bounds, end[rows], side="right"))
        place["first"][rows], place["final"][rows] = first, final
        place["high"][rows] = edges[first]  # end of the first chunk
        # The cut at or before each end; below the first cut there is none to equal.
        place["cut"][rows] = np.where(first > 0, edges[first - 1], OPEN)
        place["last"][rows] = np.where(final > 0, edges[final - 1], OPEN)
    return place


def _pieces(start, end, place, depth):
    """Pieces of all periods as (row, start, end, level, chunk) columns."""
    rows = np.arange(len(start))
    first, final = place["first"], place["final"]
    at_cut, ends_at_cut = place["cut"] == start, place["last"] == end
    parts = []

    def add(mask, low, high, level, chunk):
        parts.append(
            (rows[mask], low[mask], high[mask], np.full(mask.sum(), level), chunk[mask]))

    add(~at_cut, start, np.minimum(end, place["high"]), -1, first)
    tail = ~ends_at_cut & ((final > first) | at_cut)
    add(tail, np.maximum(start, place["last"]), end, -1, final)

    # Chunks [a, b) are covered in full: two tree nodes per level at most.
    nothing = np.full(len(rows), OPEN)
    a, b = np.where(at_cut, first, first + 1), final
    for level in range(depth + 1):
        low, high = -(-a >> level), b >> level
        some = low < high
        add(some & (low % 2 == 1), nothing, nothing, level, low)
        add(some & (high % 2 == 1), nothing, nothing, level, high - 1)
    return [np.concatenate(column) for column in zip(*parts)]


def leaf_table(cuts: dict, time_type) -> list[tuple]:
    """One (id, start, end, chunk) row per chunk that a write can cover in full."""
    from datetime import datetime, timedelta, timezone

    zone = timezone.utc if time_type.typeName() == "timestamp" else None
    epoch = datetime(1970, 1, 1, tzinfo=zone)
    rows = []
    for key, bounds in cuts.items():
        marks = [epoch + timedelta(microseconds=int(b)) for b in bounds]
        rows += [(key, lo, hi, i + 1) for i, (lo, hi) in enumerate(zip(marks, [*marks[1:], None]))]
    return rows

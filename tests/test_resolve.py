"""Every resolution plan against a per-instant replay of random write logs."""

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest

from tidemark.operators import reports
from tidemark.operators.travel import VersionedTable
from tidemark.plans import resolve, sweep
from tidemark.plans.skew import profile

EPOCH = datetime(2024, 1, 1)
SCHEMA = (
    "_id string, _valid_from timestamp_ntz, _valid_to timestamp_ntz, _tx bigint, "
    "_seq bigint, _op string, v int"
)


def at(minute):
    return None if minute is None else EPOCH + timedelta(minutes=minute)


def random_log(seed, ids, writes, span, bounded):
    rng = random.Random(seed)
    rows = []
    for n in range(writes):
        # "a" holds about half of all writes.
        key = "a" if rng.random() < 0.5 else rng.choice(ids)
        start = rng.choice([0, span // 2, rng.randrange(span)])
        end = None
        if bounded and rng.random() < 0.7:
            end = rng.choice([span // 2, span, start + rng.randrange(0, span // 3)])
        op = "delete" if rng.random() < 0.2 else "put"
        rows.append((key, start, end, n // 3, n, op, n))
    rng.shuffle(rows)
    return rows


def replay(rows, span):
    """Winner at every minute, folded into maximal versions."""
    out = []
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key and (r[2] is None or r[2] > r[1])]
        current = None
        for minute in range(span * 2 + 1):
            covering = [r for r in mine if r[1] <= minute and (r[2] is None or r[2] > minute)]
            win = max(covering, key=lambda r: (r[3], r[4]), default=None)
            value = win[6] if win and win[5] == "put" else None
            if current and current[1] != value:
                out.append((key, at(current[0]), at(minute), current[1]))
                current = None
            if value is not None and current is None:
                current = (minute, value)
        if current:
            out.append((key, at(current[0]), None, current[1]))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(
        [(r[0], at(r[1]), at(r[2]), *r[3:]) for r in rows], SCHEMA)


def result(df):
    return sorted(
        ((r["_id"], r["_valid_from"], r["_valid_to"], r["v"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,rows_per_task", [(1, None), (2, 6), (3, 12), (4, 40)])
@pytest.mark.parametrize("bounded", [False, True])
def test_versions_match_replay(spark, seed, rows_per_task, bounded):
    rows = random_log(seed, list("abcdefgh"), 220, 200, bounded)
    log = frame(spark, rows)
    expected = replay(rows, 200)
    got = resolve.versions(log, open_ended=not bounded, rows_per_task=rows_per_task)
    assert result(got) == expected


def test_open_and_swept_plans_agree(spark):
    log = frame(spark, random_log(9, list("abc"), 150, 500, False))
    assert result(resolve.versions(log, open_ended=True)) == result(resolve.versions(log))


@pytest.mark.parametrize("minute", [0, 37, 100, 199])
def test_as_of_matches_versions(spark, minute):
    rows = random_log(5, list("abcdef"), 200, 200, True)
    now = at(minute)
    expected = sorted(
        (k, v) for k, lo, hi, v in replay(rows, 200) if lo <= now and (hi is None or hi > now))
    got = sorted((r["_id"], r["v"]) for r in resolve.as_of(frame(spark, rows), now).collect())
    assert got == expected


def test_many_writes_sharing_instants_in_a_hot_id(spark):
    """Ties at one start, at one end and of whole periods all leave chunk interiors small."""
    rows = [("a", 10, 90, n, 0, "put", n) for n in range(60)]
    rows += [("a", 10, 20 + n, 100 + n, 0, "put", 100 + n) for n in range(40)]
    rows += [("a", 5 + n, 90, 200 - n, 0, "delete" if n % 3 else "put", 300 + n) for n in range(40)]
    expected = replay(rows, 100)
    assert result(resolve.versions(frame(spark, rows), rows_per_task=10)) == expected


def test_zoned_timestamps_resolve_too(spark):
    rows = random_log(11, list("abc"), 120, 150, True)
    log = frame(spark, rows)
    zoned = log.withColumns({c: log[c].cast("timestamp") for c in ("_valid_from", "_valid_to")})
    got = resolve.versions(zoned, rows_per_task=15)
    back = got.withColumns({c: got[c].cast("timestamp_ntz") for c in ("_valid_from", "_valid_to")})
    assert result(back) == replay(rows, 150)


@pytest.mark.parametrize("limit", [None, 10])
@pytest.mark.parametrize("bounded", [False, True])
def test_sets_of_instants_match_reads_at_each(spark, limit, bounded):
    log = frame(spark, random_log(13, list("abcdef"), 200, 200, bounded))
    instants = [at(m) for m in (150, 20, 100, 199, -5)]
    sets = resolve.as_of_sets(log, instants, profile(log, limit)).collect()
    each = resolve.as_of_each(log, instants).collect()
    assert sorted((r["_id"], instants[k], r["v"]) for r in sets for k in range(5) if r["_at"] >> k & 1) == sorted(
        (r["_id"], r["as_of"], r["v"]) for r in each)
    assert limit or len({(r["_id"], r["v"]) for r in sets}) == len(sets)


def trend_tables(spark):
    """Customers, orders and lines that come and go; some orders change hands, some lines have no order."""
    made = {
        "c": (40, ["k % 40 AS c_custkey"]),
        "o": (90, ["k % 90 AS o_orderkey", "k % 50 AS o_custkey"]),
        "l": (300, ["if(k % 31 = 0, null, k % 95) AS l_orderkey", "CAST(k AS double) AS l_extendedprice", "0.05D AS l_discount"])}
    return [VersionedTable(spark.range(2 * n).withColumnRenamed("id", "k").selectExpr(
        f"k % {n} AS _id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, CAST(k % 40 AS int)) AS _valid_from",
        "if(k % 7 = 0, timestamp_ntz'2024-02-01 00:00:00', null) AS _valid_to", "k AS _tx", "0L AS _seq",
        "timestamp_ntz'2024-01-01 00:00:00' AS _system_from", "if(k % 11 = 0, 'delete', 'put') AS _op", *columns)) for n, columns in made.values()]


def test_a_trend_shuffles_a_write_once(spark):
    tables = trend_tables(spark)
    days = ["2024-01-10 00:00:00", "2024-01-25 00:00:00", "2024-02-20 00:00:00"]
    got = reports.billing_trend(*tables, [*days, "2024-01-10", "2023-01-01"])
    expected = []
    for day in days:
        c, o, lines = (t.as_of(day) for t in tables)
        held = o.join(c, o.o_custkey == c.c_custkey, "left_semi")
        sold = lines.join(held, lines.l_orderkey == held.o_orderkey, "left_semi").collect()
        expected.append((c.count(), held.count(), len(sold), round(sum(r["l_extendedprice"] * 0.95 for r in sold), 2)))
    found = sorted(got.collect(), key=lambda r: r["as_of"])
    assert [str(r["as_of"]) for r in found] == days
    assert [(r["customers"], r["order_count"], r["line_item_count"], r["total_revenue"]) for r in found] == expected
    # Rows are dealt to instants once they are totals, so below the first shuffle of a write there is no copying.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2


def test_a_worker_resolves_few_rows_at_once():
    """What a worker holds does not grow with the rows of its task."""
    n = 100_000
    moment = pa.array([0] * n, pa.timestamp("us"))
    rows = pa.table({
        "_id": pa.array(range(n)), "_valid_from": moment, "_valid_to": pa.array([1] * n, pa.timestamp("us")),
        "_tx": pa.array([1] * n), "_seq": pa.array([0] * n), "_put": pa.array([True] * n)})
    found = list(sweep.resolver(rows.column_names, ["_id"])(iter(rows.to_batches(max_chunksize=10_000))))
    assert sum(b.num_rows for b in found) == n
    assert max(b.num_rows for b in found) <= 50_000

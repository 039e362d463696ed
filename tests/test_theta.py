"""Inequality joins against all pairs."""

import random
from datetime import datetime, timedelta
from decimal import Decimal
from operator import ge, gt, le, lt

import pytest

from tidemark.operators.theta import theta_join

SIGNS = {"<": lt, "<=": le, ">": gt, ">=": ge}


def rows_of(seed, n, heavy):
    rng = random.Random(seed)
    return [(k, None if rng.random() < 0.05 else heavy if rng.random() < 0.35 else rng.randrange(200)) for k in range(n)]


def pairs(a, b, sign, value=lambda v: v):
    return sorted((i, j) for i, x in a for j, y in b if x is not None and y is not None and SIGNS[sign](value(x), value(y)))


def found(df):
    return sorted((r["a"], r["b"]) for r in df.select("a", "b").collect())


@pytest.mark.parametrize("sign", SIGNS)
@pytest.mark.parametrize("bands", [1, 16])
def test_pairs_by_brute_force(spark, sign, bands):
    a, b = rows_of(1, 120, 50), rows_of(2, 90, 50)
    left = spark.createDataFrame(a, "a int, x int")
    right = spark.createDataFrame(b, "b int, y bigint")
    assert found(theta_join(left, sign, right, "x", "y", bands)) == pairs(a, b, sign)


@pytest.mark.parametrize("kind, value", [
    ("decimal(30,12)", lambda v: Decimal(v) / 10 ** 12), ("decimal(10,2)", lambda v: Decimal(v) / 100), ("double", lambda v: v / 7),
    ("timestamp_ntz", lambda v: datetime(1969, 12, 31) + timedelta(minutes=v)), ("date", lambda v: (datetime(1969, 12, 1) + timedelta(days=v)).date()),
    ("bigint", lambda v: (1 << 60) + v)])
def test_kinds_of_values(spark, kind, value):
    a, b = rows_of(3, 80, 120), rows_of(4, 80, 120)
    made = lambda rows, names: spark.createDataFrame([(k, None if v is None else value(v)) for k, v in rows], f"{names[0]} int, {names[1]} {kind}")
    for sign in ("<", ">="):
        assert found(theta_join(made(a, "ax"), sign, made(b, "by"), "x", "y", 9)) == pairs(a, b, sign)


def test_nan_and_empty_sides_match_nothing(spark):
    a = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, float("inf")), (4, float("-inf"))], "a int, x double")
    b = spark.createDataFrame([(1, 2.0), (2, float("nan")), (3, float("inf"))], "b int, y double")
    assert found(theta_join(a, "<", b, "x", "y")) == [(2, 1), (2, 3), (4, 1), (4, 3)]
    assert found(theta_join(a, ">=", b, "x", "y", 2)) == [(3, 1), (3, 3)]
    assert theta_join(a.limit(0), "<", b, "x", "y").count() == 0
    with pytest.raises(ValueError):
        theta_join(a, "<", a, "x", "x")


def test_few_matches_of_large_sides_and_no_product(spark):
    a = spark.range(100_000).selectExpr("id AS a", "id AS x")
    b = spark.range(100_000).selectExpr("id AS b", "id - 99990 AS y")
    joined = theta_join(a, "<", b, "x", "y")
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert joined.count() == sum(range(10))


@pytest.mark.parametrize("few, many", [(500, 10_000), (10_000, 500)])
def test_many_pairs_are_stored_in_few_bytes(spark, tmp_path, few, many):
    """The result is larger than the input by far, so its order must let files repeat themselves."""
    left = spark.range(few).selectExpr("pmod(xxhash64(id), 1000003) AS a", "pmod(hash(id), 1000) AS x")
    right = spark.range(many).selectExpr("pmod(xxhash64(id, 1), 1000003) AS b", "pmod(hash(id, 1), 1000) AS y")
    path = tmp_path / "pairs"
    theta_join(left, "<", right, "x", "y", 256).write.parquet(str(path))
    pairs = spark.read.parquet(str(path)).count()
    assert pairs == left.join(right, left.x < right.y).count()
    assert sum(f.stat().st_size for f in path.glob("*.parquet")) < 0.8 * pairs

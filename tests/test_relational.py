"""Unification and friends on a small film collection."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import nested
from tidemark.operators import relational
from tidemark.operators.relational import bind, unify, unnest

PERSONS = [(1, "James Cameron", 1954), (2, "Arnold Schwarzenegger", 1947), (3, "Linda Hamilton", 1956),
           (4, "Sigourney Weaver", 1949), (5, "Ridley Scott", 1937), (6, "Michael Biehn", 1956),
           (7, "George Miller", 1945), (8, "Mel Gibson", 1956)]
# id, title, year, director(s) as JSON, cast, sequel
MOVIES = [(10, "The Terminator", 1984, "1", [2, 3, 6], 11),
          (11, "Terminator 2: Judgment Day", 1991, "1", [2, 3], None),
          (12, "Aliens", 1986, "1", [4, 6], None),
          (13, "Alien", 1979, "5", [4], 12),
          (14, "Mad Max", 1979, "7", [8], 15),
          (15, "Mad Max Beyond Thunderdome", 1985, "[7, 9]", [8], None)]


@pytest.fixture(scope="module")
def persons(spark):
    return spark.createDataFrame(PERSONS, "id int, name string, born int")


@pytest.fixture(scope="module")
def movies(spark):
    df = spark.createDataFrame(
        MOVIES, "id int, title string, year int, director string, cast array<int>, sequel int")
    return df.withColumn("director", F.parse_json("director"))


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]]
                  for r in df.collect())


def directors(movies):
    return movies.select("id", nested.scalar_key("director", "int").alias("d"), "title", "cast")


def test_director_of(persons, movies):
    found = unify(
        bind(directors(movies), d="d", title=F.lit("Alien")),
        bind(persons, d="id", name="name"))
    assert values(found, "name") == ["Ridley Scott"]


def test_directors_of_an_actor_keep_duplicates(persons, movies):
    cast = unnest(directors(movies), "cast", "a").select("a", "d")
    found = unify(
        bind(persons, a="id", name=F.lit("Arnold Schwarzenegger")),
        cast, bind(persons, d="id", director="name"))
    assert values(found, "director") == ["James Cameron", "James Cameron"]


def test_movies_shared_by_two_people(persons, movies):
    cast = unnest(directors(movies), "cast", "a").select("a", "d", "title")
    found = unify(
        cast,
        bind(persons, a="id", name=F.lit("Michael Biehn")),
        bind(persons, d="id", dname="name").where("dname = 'James Cameron'"))
    assert values(found, "title") == ["Aliens", "The Terminator"]


def test_parameter_relation(spark, persons, movies):
    wanted = relational.rel(
        spark, [{"name": "James Cameron", "x": 1}, {"name": "Ridley Scott"}], "name string")
    found = unify(directors(movies).select("d", "title"), wanted, bind(persons, d="id", name="name"))
    assert len(values(found, "title")) == 4


def test_older_than(persons):
    """A theta join: one side is one row, written down as a literal relation."""
    found = unify(
        bind(persons, name="name", b2="born"),
        relational.literal(bind(persons.where("name = 'Arnold Schwarzenegger'"), b1="born")),
        where=[F.col("b2") < F.col("b1")])
    assert values(found, "name") == ["George Miller", "Ridley Scott"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_unrelated_relations_need_a_literal(spark):
    """Whether a query is answered depends on what it says, not on row counts."""
    a, b = spark.range(20).toDF("a"), spark.range(3000).toDF("b")
    for few in (b, b.where("b < 2"), b.where("b < 0")):
        with pytest.raises(ValueError, match="share no variable"):
            unify(a, few)
    assert unify(a, relational.literal(b.where("b < 2"))).count() == 40
    assert unify(relational.literal(b.where("b < 0")), a).count() == 0
    with pytest.raises(ValueError, match="no literal relation"):
        relational.literal(b)


def test_counting_an_inequality_join(spark):
    """More than a thousand rows on both sides, ties and nulls, and no product in the plan."""
    values = [(None if k % 97 == 0 else (k * 37 % 500) / 4,) for k in range(3000)]
    limits = [(k, None if k % 89 == 0 else (k * 11 % 600) / 4) for k in range(1500)]
    found = relational.count_above(
        spark.createDataFrame(values, "v double"), "v", spark.createDataFrame(limits, "k int, l double"), "l", 7.0, "n")
    want = {k: sum(v is not None and limit is not None and v > limit for (v,) in values) for k, limit in limits}
    assert {r["k"]: r["n"] for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "explode" not in plan


def test_repeated_variable_equates_columns(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "p int, q int, t string")
    assert values(bind(df, v=("p", "q"), t="t"), "t") == ["x"]


def test_array_valued_key_does_not_join(persons, movies):
    joined = unify(bind(directors(movies), d="d", title="title"), bind(persons, d="id"))
    assert "Mad Max Beyond Thunderdome" not in values(joined, "title")
    assert joined.count() == 5


def test_sequels(movies):
    sequel = bind(movies, sequel="id", next="title")
    found = unify(bind(movies, title="title", sequel="sequel"), sequel)
    assert values(found, "title", "next") == [
        ("Alien", "Aliens"), ("Mad Max", "Mad Max Beyond Thunderdome"),
        ("The Terminator", "Terminator 2: Judgment Day")]


def test_unnest_drops_empty(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, xs array<int>")
    assert values(unnest(df, "xs", "x"), "id", "x") == [(1, 1), (1, 2)]


def test_nest_one(spark, persons):
    one = relational.nest_one(persons.where("id = 5"), "p").first()["p"]
    assert one["name"] == "Ridley Scott"
    assert relational.nest_one(persons.where("id = 99"), "p").first()["p"] is None
    with pytest.raises(Exception, match="more than one row"):
        relational.nest_one(persons, "p").collect()


def test_labels_may_repeat(spark):
    df = spark.createDataFrame([("mobile",), ("unknown",), (None,), (None,)], "device string")
    got = relational.count_by_label(df, "device", "unknown", "n")
    assert values(got, "device", "n") == [("mobile", 1), ("unknown", 1), ("unknown", 2)]


def test_semi_join_first(spark):
    t = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b"), (1, "z")], "k int, v string")
    assert values(relational.semi_join_first(t, "k", t.select("k").distinct(), 2), "v") == ["a", "b", "z"]


def test_polymorphic_values(spark):
    trades = spark.createDataFrame(
        [(1, "Trade1", 1001, '{"some_nested":["json",42,{"data":["hello"]}]}'),
         (2, "Trade2", 15, "2"), (3, "Trade3", 200, "3")],
        "_id int, name string, quantity int, info string").withColumn("info", F.parse_json("info"))
    big = trades.where("quantity > 100")
    assert values(big, "name") == ["Trade1", "Trade3"]
    got = trades.orderBy("_id").select(
        nested.path("info", "some_nested", 2, "data", 0).alias("deep"),
        nested.scalar_key("info", "int").alias("n"), nested.kind("info").alias("kind")).collect()
    assert [r["deep"] for r in got] == ["hello", None, None]
    assert [r["n"] for r in got] == [None, 2, 3]
    assert got[0]["kind"].startswith("OBJECT") and got[1]["kind"] == "BIGINT"


def test_array_positions(spark):
    df = spark.createDataFrame([([10, 20],)], "a array<int>")
    got = df.select(nested.nth("a", 0), nested.element("a", 1), nested.nth("a", 5)).first()
    assert tuple(got) == (10, 10, None)

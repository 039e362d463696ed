"""Loaders and writers on small inline files."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.columns import instant_literal
from tidemark.functions import infer, names, temporal
from tidemark.sources import catalog, records, transit, tsv


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


# -- TSV ------------------------------------------------------------------------------

def test_tsv_table_is_typed_and_keyed(spark, tmp_path):
    path = write(tmp_path / "public_staff.tsv", (
        "staff_id\tname\tactive\tsalary\t_valid_from\tpicture\n"
        "1\tMike\tt\t10.5\t2006-02-15 04:34:33\t\\N\n"
        "2\tJon \tfalse\t7\t2006-02-16 00:00:00\t\\N\n"))
    df = tsv.read_tsv(spark, path)
    assert dict(df.dtypes) == {
        "_id": "bigint", "name": "string", "active": "boolean", "salary": "double",
        "_valid_from": "timestamp_ntz", "picture": "string"}
    rows = {r["_id"]: r for r in df.collect()}
    assert rows[1]["active"] is True and rows[2]["active"] is False
    assert rows[2]["name"] == "Jon " and rows[1]["picture"] is None
    assert rows[1]["_valid_from"] == datetime(2006, 2, 15, 4, 34, 33)


def test_tsv_join_table_id(spark, tmp_path):
    path = write(tmp_path / "public_film_category.tsv", "film_id\tcategory_id\n997\t12\n1\t6\n")
    got = {(r["_id"], r["film_id"]) for r in tsv.read_tsv(spark, path).collect()}
    assert got == {("997_12", 997), ("1_6", 1)}


def test_tsv_table_with_id_is_unchanged(spark, tmp_path):
    path = write(tmp_path / "public_city.tsv", "_id\tcity\n5\tLund\n")
    assert tsv.read_tsv(spark, path).columns == ["_id", "city"]


def test_tsv_count_mismatch(spark, tmp_path):
    path = write(tmp_path / "public_actor.tsv", "actor_id\tfirst\tlast\n1\tA\tB\n2\tC\n3\tD\t\n")
    with pytest.raises(ValueError, match="column count mismatch"):
        tsv.read_tsv(spark, path)
    good, bad = tsv.split_lines(spark, path)
    assert [r["found"] for r in bad.collect()] == [2]
    # A trailing empty value is a value.
    assert sorted(r["actor_id"] for r in good.collect()) == ["1", "3"]


def test_tsv_directory_isolates_failures(spark, tmp_path):
    write(tmp_path / "public_language.tsv", "language_id\tname\n1\tEnglish   \n")
    write(tmp_path / "public_broken.tsv", "broken_id\tx\n1\n")
    seen = {}
    loaded = tsv.load_directory(spark, str(tmp_path), lambda t, df: seen.update({t: df.count()}))
    assert seen == {"language": 1} and list(loaded.tables) == ["language"]
    assert list(loaded.errors) == ["broken"]
    assert tsv.check_count(loaded.tables["language"], 1) == 1
    with pytest.raises(ValueError, match="expected 16044"):
        tsv.check_count(loaded.tables["language"], 16044, "rental")


@pytest.mark.parametrize("value,kind", [
    ("12", "long"), ("-7", "long"), ("1.50", "double"), ("99999999999999999999", "huge"), ("9007199254740993", "wide"), ("9" * 39, "string"),
    ("T", "boolean"), ("false", "boolean"), ("2024-02-30", "string"), ("2024-02-29", "date"),
    ("2024-02-29 10:11:12", "timestamp"), ("\\N", "null"), (None, "null"), ("", "string"),
    ("1.", "string"), ("abc", "string"),
])
def test_kind_of(spark, value, kind):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(infer.kind_of(F.col("v"))).first()[0] == kind


def test_mixed_kinds_widen(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-01", "t", "1"), ("2.5", "2024-01-01 10:00:00", "\\N", "x")],
        "a string, b string, c string, d string")
    assert infer.column_types(df) == {
        "a": "double", "b": "timestamp_ntz", "c": "boolean", "d": "string"}


# -- transit --------------------------------------------------------------------------

# Fixed: the marks of maps, tags, sets, keywords and dates.
BOAT = (
    '["^ ","~:hull","b7","~:launched","~t2019-04-30","~:refit",["~#time/zoned-date-time","2023-11-02T06:45Z[UTC]"],'
    '"~:afloat",false,"~:length",9.75,"~:rig",["sloop","furling"],"~:flags",["~#set",["blue","red","blue"]],'
    '"~:log",["^ ","~:keeper","~:harbour-master","~:visits",["^ ","~:arrivals",["~t2024-03-01T05:10:00Z","~t2024-03-09T17:45:00Z"]]]]')
SCHEMA = (
    "hull string, launched date, refit string, afloat boolean, length double, rig array<string>, flags array<string>, "
    "log struct<keeper: string, visits: struct<arrivals: array<timestamp>>>, missing int")


def test_transit_typed(spark, tmp_path):
    path = write(tmp_path / "boats.json", BOAT + "\n\n")
    rows = transit.read_lines(spark, path, SCHEMA, id_key="hull")
    rows = rows.withColumn("refit", temporal.parse_iso(F.col("refit")))
    r = rows.first()
    assert r["_id"] == "b7" and r["launched"] == date(2019, 4, 30) and r["missing"] is None
    assert r["rig"] == ["sloop", "furling"] and r["flags"] == ["blue", "red"]
    assert r["log"]["keeper"] == "harbour-master"
    first = rows.select(
        F.date_format(F.element_at("log.visits.arrivals", 1), "yyyy-MM-dd'T'HH:mm"),
        F.date_format("refit", "yyyy-MM-dd")).first()
    assert tuple(first) == ("2024-03-01T05:10", "2023-11-02")


def test_transit_variant(spark, tmp_path):
    path = write(tmp_path / "boats.json", BOAT + "\n")
    r = transit.read_lines(spark, path, id_key="hull").select(
        "_id", F.try_variant_get("doc", "$.log.visits.arrivals[0]", "timestamp")
        .cast("string").alias("t")).first()
    assert (r["_id"], r["t"]) == ("b7", "2024-03-01 05:10:00")


def test_transit_lines_that_cannot_be_read(spark, tmp_path):
    path = write(tmp_path / "p.json", '["^ ","_id","a"]\n["^ ","_id",\n')
    assert [r["_id"] for r in transit.read_lines(spark, path, "_id string").collect()] == ["a"]
    assert [r["value"] for r in transit.rejected_lines(spark, path).collect()] == ['["^ ","_id",']


def test_transit_of_dynamic_values(spark):
    rows = spark.sql("""SELECT parse_json('{"a": {"b": [1, "^x"]}, "c": null}') AS doc, map('k', 1, 'm', 2) AS counts,
      map('only', parse_json('[{"z": true}]')) AS deep, cast(map() as map<string,int>) AS none""")
    line = json.loads(transit.to_lines(rows).first()[0])
    assert line == ["^ ", "~:doc", ["^ ", "a", ["^ ", "b", [1, "~^x"]], "c", None], "~:counts", ["^ ", "k", 1, "m", 2],
                    "~:deep", ["^ ", "only", [["^ ", "z", True]]], "~:none", ["^ "]]


def test_text_that_is_no_document_is_rejected(spark):
    rows = spark.createDataFrame([('{"_id": 1}',), ('{"k": 1}',), ('{"_id":',), ("",), (None,)], "t string")
    assert [r["_id"] for r in records.from_json_text(rows, "t", "bigint").collect()] == [1]
    got = {(r["t"], r["reject_reason"]) for r in records.rejected_json(rows, "t", "bigint").collect()}
    assert got == {('{"k": 1}', "no id"), ('{"_id":', "not json"), ("", "empty value"), (None, "empty value")}


def test_a_line_equal_to_the_header_is_data(spark, tmp_path):
    path = write(tmp_path / "t.tsv", "a\tb\nx\t1\na\tb\n")
    good, bad = tsv.split_lines(spark, path)
    assert sorted(map(tuple, good.collect())) == [("a", "b"), ("x", "1")] and bad.count() == 0


def test_large_whole_numbers_stay_apart(spark):
    rows = spark.createDataFrame([("99999999999999999999", "9007199254740993"), ("99999999999999999998", "0.5")], "id string, mixed string")
    typed = infer.typed(rows)
    assert typed.select("id").distinct().count() == 2
    assert infer.column_types(rows) == {"id": "decimal(38,0)", "mixed": "string"}


def test_naive_instants_do_not_move_with_the_zone(spark):
    zone, noon = spark.conf.get("spark.sql.session.timeZone"), datetime(2024, 1, 1, 12)
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert spark.range(1).select(instant_literal(noon, T.TimestampNTZType()).cast("string")).first()[0] == "2024-01-01 12:00:00"
            assert spark.range(1).select(instant_literal(noon, T.TimestampType()).cast("string")).first()[0] == "2024-01-01 12:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_pair_is_a_tag_only_with_the_mark(spark, tmp_path):
    path = write(tmp_path / "p.json", '["^ ","_id","a","pair",["x","y"],"odd","~~tilde"]\n')
    r = transit.read_lines(spark, path, "_id string, pair array<string>, odd string").first()
    assert r["pair"] == ["x", "y"] and r["odd"] == "~tilde"


def test_transit_round_trip(spark, tmp_path):
    schema = (
        "_id string, n int, x double, ok boolean, d date, at timestamp, wall timestamp_ntz, "
        "tags array<string>, meta struct<role: string, deep: struct<xs: array<int>>>, gone string")
    row = ("a\"b\\c\n~", 1, 2.5, True, date(2024, 1, 15), datetime(2024, 1, 15, 9, 30),
           datetime(2024, 1, 15, 9, 30, 1, 250000), ["~x", "é"], ("r", ([1, 2],)), None)
    df = spark.createDataFrame([row], schema)
    out = str(tmp_path / "out")
    transit.to_lines(df).write.text(out)
    back = transit.read_lines(spark, out, schema)
    assert back.first().asDict(True) == df.first().asDict(True)
    line = transit.to_lines(df.select("n", "d", "gone")).first()[0]
    assert json.loads(line) == ["^ ", "~:n", 1, "~:d", "~t2024-01-15", "~:gone", None]


# -- documents and names --------------------------------------------------------------

BOATS = [
    {"_id": "b7", "name": "Teal", "berths": 4, "afloat": True, "length": 9.75,
     "rig": ["sloop", "furling"], "home": {"harbour": "Lerwick", "pier": 2}},
    {"_id": "b8", "name": "Gannet", "berths": 6, "afloat": False, "length": 12.5,
     "rig": ["ketch"], "home": {"harbour": "Oban", "pier": 11}},
]


def test_json_array_file(spark, tmp_path):
    path = write(tmp_path / "users.json", json.dumps(BOATS, indent=1))
    df = records.read_json_array(spark, path).orderBy("_id")
    assert [r["name"] for r in df.collect()] == [u["name"] for u in BOATS]
    assert df.first()["home"]["pier"] == 2


def test_json_text_needs_no_field_list(spark):
    df = spark.createDataFrame([(json.dumps(b),) for b in BOATS] + [("{bad",)], "doc_text string")
    docs = records.from_json_text(df, "doc_text")
    typed = records.promote(docs, {"berths": "int", "absent": "string"}).orderBy("_id")
    assert [tuple(r) for r in typed.select("_id", "berths", "absent").collect()] == [("b7", 4, None), ("b8", 6, None)]


def test_absent_is_not_null(spark):
    df = spark.createDataFrame([('{"a":1,"b":null}',), ('{"a":2}',)], "t string")
    keys = df.select(records.provided_keys(F.parse_json("t")).alias("k"))
    assert sorted(sorted(r["k"]) for r in keys.collect()) == [["a"], ["a", "b"]]


def test_jagged_literals(spark):
    df = records.from_literals(spark, [{"_id": 1, "x": "a"}, {"_id": 2, "y": 2.5}])
    assert {tuple(r) for r in df.collect()} == {(1, "a", None), (2, None, 2.5)}


def test_names(spark):
    assert names.normalise(":movie/title") == "movie$title"
    assert names.normalise(":a.b/c-d") == "a$b$c_d"
    assert names.normalise(":thing/id", id_key="thing/id") == "_id"
    assert names.table_identifier("user states;--") == "userstates"
    df = spark.createDataFrame([(1, 2)], ["a.b", "a/b"])
    with pytest.raises(ValueError, match="same column"):
        names.normalise_columns(df)


@pytest.mark.parametrize("text,expected", [
    ("2020-01-15T00:00Z[UTC]", "2020-01-15 00:00:00"),
    ("2020-01-15T10:30:05Z", "2020-01-15 10:30:05"),
    ("2020-01-15T10:30+02:00[Europe/Stockholm]", "2020-01-15 08:30:00"),
    ("nonsense", None),
])
def test_parse_iso(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(temporal.parse_iso(F.col("t")).cast("string")).first()[0] == expected


@pytest.mark.parametrize("text,seconds", [
    ("PT1H3M5.533S", "3785.533000"), ("P163DT12H", "14126400.000000"), ("P1D", "86400.000000"),
    ("P", None), ("1H", None), ("PT", None),
])
def test_parse_duration(spark, text, seconds):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(temporal.seconds_of(temporal.parse_duration(F.col("t"))).cast("string")).first()[0]
    assert got == seconds


@pytest.mark.parametrize("text,nanos", [
    ("13:30", 48_600_000_000_000), ("00:00:01.5", 1_500_000_000), ("24:00", None),
])
def test_time_to_nanos(spark, text, nanos):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(temporal.time_to_nanos(F.col("t"))).first()[0] == nanos


def test_periods(spark):
    row = spark.range(1).select(
        temporal.period(F.lit(1), F.lit(5)).alias("a"), temporal.period(F.lit(5), F.lit(None)).alias("b"),
        temporal.period(F.lit(4), F.lit(6)).alias("c")).select(
        temporal.period_overlaps(F.col("a"), F.col("b")), temporal.period_overlaps(F.col("a"), F.col("c")),
        temporal.period_contains(F.col("b"), F.lit(9)), temporal.period_contains(F.col("a"), F.lit(5)))
    assert tuple(row.first()) == (False, True, True, False)


def test_rough_age(spark):
    df = spark.createDataFrame([(date(1990, 12, 31),)], "born date")
    got = df.select(
        temporal.age(F.col("born"), F.lit("2020-01-01").cast("date")),
        temporal.age(F.col("born")) == F.year(F.current_date()) - 1990).first()
    assert tuple(got) == (30, True)


# -- catalog and hand-off --------------------------------------------------------------

def test_catalog_listing_and_scalar_query(spark):
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("zz_listed")
    found = catalog.list_tables(spark)
    assert "zz_listed" in [r["table_name"] for r in found.collect()]
    assert catalog.list_tables(spark, limit=1).count() == 1
    assert catalog.spark_version(spark).first()["version"].startswith("4.")
    row = spark.sql("SELECT 1 + 1 AS two, upper('hello') AS loud").first()
    assert tuple(row) == (2, "HELLO")


def test_many_databases(spark, tmp_path):
    for name, df in {
        "left_db.customer": spark.createDataFrame([(1, "a")], "k int, n string"),
        "right_db.orders": spark.createDataFrame([(1, 9.5)], "k int, p double"),
    }.items():
        database = name.split(".")[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{tmp_path}/{database}'")
        df.write.mode("overwrite").saveAsTable(name)
    got = spark.sql(
        "SELECT n, p FROM left_db.customer c JOIN right_db.orders o ON c.k = o.k").collect()
    assert [tuple(r) for r in got] == [("a", 9.5)]
    for database in ("left_db", "right_db"):
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_columnar_hand_off(spark):
    df = spark.createDataFrame([(1, "Anchor", 12.5)], "_id int, name string, price double")
    table = df.toArrow()
    assert table.column_names == ["_id", "name", "price"] and table.num_rows == 1
    assert df.toPandas()["price"].tolist() == [12.5]


def test_nested_round_trip(spark, tmp_path):
    schema = (
        "simple array<int>, strings array<string>, nested struct<field: string, xs: array<int>>, "
        "objects array<struct<id: int, name: string>>")
    df = spark.createDataFrame(
        [([1, 2, 3], ["a", "b", "c"], ("v", [4]), [(1, "x"), (2, "y")])], schema)
    df.write.parquet(str(tmp_path / "nested"))
    assert spark.read.parquet(str(tmp_path / "nested")).collect() == df.collect()

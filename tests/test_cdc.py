"""Change events: parsing rules, applying, and the stream."""

import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.columns import VALID_FROM, VALID_TO
from tidemark.operators import relational
from tidemark.operators.travel import VersionedTable
from tidemark.sources import cdc
from tidemark.sources.store import LogStore
from tidemark.streaming import cdc_stream

NOW = "2024-06-01 00:00:00"


def ms(day, hour=0):
    return int(datetime(2024, 1, day, hour, tzinfo=timezone.utc).timestamp() * 1000)


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def event(op, table, when, after=None, before=None):
    return {"_comment": "ignored", "payload": {
        "op": op, "ts_ms": when, "source": {"db": "app", "table": table},
        "before": before, "after": after}}


EVENTS = [
    event("c", "users", ms(1), {"id": 1, "email": "a@x", "username": "alice"}),
    event("c", "users", ms(1, 1), {"id": 2, "email": "b@x", "username": "bob"}),
    event("c", "users", ms(1, 2), {"id": 3, "email": "c@x", "username": "charlie"}),
    event("c", "profiles", ms(1, 3), {"id": 1, "user_id": 1, "display_name": "Al"}),
    event("u", "users", ms(2), {"id": 1, "email": "a@x", "username": "alice", "phone_number": "1"},
          {"id": 1}),
    event("c", "sessions", ms(2, 1), {"id": 1, "user_id": 1, "token": "t", "device_type": "mobile"}),
    event("c", "sessions", ms(2, 2), {"id": 2, "user_id": 2, "token": "u"}),
    event("d", "users", ms(3), None, {"id": 3, "username": "charlie"}),
    event("c", "users", ms(3, 1), {"id": 4, "email": "d@x", "username": "diana", "phone_number": "4"}),
    # Out of order: bob's address changed before charlie was deleted.
    event("u", "users", ms(2, 12), {"id": 2, "email": "bob@new", "username": "bob"}),
]


def frame(spark, events):
    return spark.createDataFrame(
        [(i, e if e is None or isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events)],
        "_position bigint, event string")


def ids(df):
    return sorted(r["_id"] for r in df.collect())


@pytest.fixture(scope="module")
def log(spark):
    return cdc.to_log(cdc.normalise(frame(spark, EVENTS), NOW), 0, NOW)


def users(log):
    typed = log.where("table = 'users'").drop("table").select(
        "*", F.try_variant_get("doc", "$.email", "string").alias("email"),
        F.try_variant_get("doc", "$.phone_number", "string").alias("phone_number")).drop("doc")
    return VersionedTable(typed, open_ended=True)


def test_current_and_history(log):
    table = users(log)
    assert ids(table.current(NOW)) == ["1", "2", "4"]
    assert table.all_versions().count() == 6
    closed = table.closed_versions().select("_id", VALID_TO).collect()
    assert sorted((r["_id"], r[VALID_TO]) for r in closed) == [
        ("1", at(2)), ("2", at(2, 12)), ("3", at(3))]
    assert ids(table.deleted_ids(NOW)) == ["3"]


def test_as_of_with_late_event_and_new_column(log):
    table = users(log)
    early = {r["_id"]: r for r in table.as_of(at(1, 12)).collect()}
    assert set(early) == {"1", "2", "3"} and early["1"]["phone_number"] is None
    later = {r["_id"]: r for r in table.as_of(at(2, 18)).collect()}
    assert later["2"]["email"] == "bob@new" and later["1"]["phone_number"] == "1"
    generation = table.all_versions().where("_id = '1'").orderBy(VALID_FROM).select(
        F.when(F.col("phone_number").isNull(), "before").otherwise("after").alias("g"))
    assert [r["g"] for r in generation.collect()] == ["before", "after"]


def test_joins_and_counts_over_current_tables(log):
    def current(name, **fields):
        rows = cdc.route(log, name)
        made = [F.try_variant_get("doc", f"$.{k}", t).alias(k) for k, t in fields.items()]
        return VersionedTable(rows, open_ended=True).current(NOW).select("_id", *made)

    people = current("users", username="string")
    profiles = current("profiles", user_id="string", display_name="string")
    sessions = current("sessions", user_id="string", device_type="string")
    joined = people.join(profiles, people["_id"] == profiles["user_id"], "left")
    assert joined.count() == 3 and joined.where("display_name IS NOT NULL").count() == 1
    counts = relational.table_counts({"users": people, "profiles": profiles, "sessions": sessions})
    assert {tuple(r) for r in counts.collect()} == {("users", 3), ("profiles", 1), ("sessions", 2)}
    devices = relational.count_by_label(sessions, "device_type", "unknown", "n")
    assert {tuple(r) for r in devices.collect()} == {("mobile", 1), ("unknown", 1)}


def test_tally(spark):
    extra = [event("r", "users", ms(4), {"id": 9})]
    counted = cdc.tally(cdc.normalise(frame(spark, EVENTS + extra), NOW))
    assert {tuple(r) for r in counted.collect()} == {
        ("users", "insert", 4), ("users", "update", 2), ("users", "delete", 1),
        ("users", "snapshot", 1), ("profiles", "insert", 1), ("sessions", "insert", 2)}


SOURCE = {"db": "app", "table": "t", "ts_ms": ms(5)}


@pytest.mark.parametrize("given,reason", [
    (None, "empty value"), ("", "empty value"), ("{oops", "not json"),
    ({"source": None, "op": "c", "after": {"id": 1}}, "no source"),
    ({"source": SOURCE, "ddl": "ALTER TABLE t", "after": {"id": 1}}, "schema event"),
    ({"source": SOURCE, "tableChanges": [], "after": {"id": 1}}, "schema event"),
    ({"source": SOURCE, "op": "c"}, "no payload"),
    ({"source": {"db": "app"}, "op": "c", "after": {"id": 1}}, "no table"),
    ({"source": SOURCE, "op": "d", "before": None, "after": {"id": 1}}, "no data"),
    ({"source": SOURCE, "op": "u", "after": {"id": None}}, "no id"),
    ({"source": SOURCE, "op": "x", "after": {"id": 1}}, "unknown op"),
    ({"__op": "c", "id": 1}, "no table"),
    ({"source": SOURCE, "op": "c", "after": {"id": 1}}, None),
    ({"source": SOURCE, "after": {"id": 1}}, None),
    ({"__table": "a.b.t", "id": 1}, None),
])
def test_rejects(spark, given, reason):
    row = cdc.normalise(frame(spark, [given]), NOW).first()
    assert row["reject_reason"] == reason


@pytest.mark.parametrize("given,table,op,deleted,when", [
    ({"source": SOURCE, "after": {"id": 1}}, "t", "r", False, at(5)),
    ({"source": {"table": "t", "ts_ms": str(ms(6))}, "op": "c", "after": {"id": 1}}, "t", "c", False, at(6)),
    ({"source": {"table": "t", "ts_ms": "soon"}, "op": "c", "after": {"id": 1}}, "t", "c", False,
     datetime(2024, 6, 1)),
    ({"__table": "db.public.t", "__source_ts_ms": ms(7), "id": 1}, "t", "c", False, at(7)),
    ({"__table": "t", "__op": "u", "__deleted": "true", "__source_ts_ms": ms(7), "id": 1}, "t", "u", True, at(7)),
    ({"__table": "t", "__op": "d", "__source_ts_ms": ms(7) + 123, "id": 1}, "t", "d", True,
     datetime(2024, 1, 7, 0, 0, 0, 123000)),
    ({"payload": {"op": "u", "ts_ms": ms(8), "source": {"table": "t"}, "after": {"id": 1}}}, "t", "u",
     False, at(8)),
])
def test_forms(spark, given, table, op, deleted, when):
    row = cdc.normalise(frame(spark, [given]), NOW).first()
    assert (row["table"], row["op"], row["deleted"], row["valid_from"], row["reject_reason"]) == (
        table, op, deleted, when, None)


def test_payload_drops_metadata_and_id(spark):
    given = {"__table": "t", "__op": "c", "id": 1, "name": "n", "none": None, "xs": [1, {"y": 2}]}
    row = cdc.to_log(cdc.normalise(frame(spark, [given]), NOW), 0, NOW).select(
        "_id", F.to_json("doc").alias("doc")).first()
    assert row["_id"] == "1"
    assert json.loads(row["doc"]) == {"name": "n", "none": None, "xs": [1, {"y": 2}]}


def test_other_id_field(spark):
    given = {"source": SOURCE, "op": "c", "after": {"key": "k1", "v": 1}}
    row = cdc.to_log(cdc.normalise(frame(spark, [given]), NOW, id_field="key"), 0, NOW, "key").first()
    assert row["_id"] == "k1"


def test_array_file(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text(json.dumps(EVENTS, indent=2))
    events = cdc.read_array_file(spark, str(path))
    assert [r[0] for r in events.select("_position").orderBy("_position").collect()] == list(range(10))
    got = users(cdc.to_log(cdc.normalise(events, NOW), 0, NOW))
    assert ids(got.current(NOW)) == ["1", "2", "4"]


# -- stream --------------------------------------------------------------------------

def add_file(directory, name, events):
    (directory / name).write_text("\n".join(json.dumps(e) for e in events) + "\n")


def test_stream_batches_restart_and_replay(spark, tmp_path):
    incoming, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    incoming.mkdir()
    store = LogStore(spark, str(tmp_path / "store"))

    def run():
        query = cdc_stream.apply(
            cdc_stream.from_files(spark, str(incoming)), store, checkpoint, monitor=("users",))
        query.awaitTermination()

    def current():
        return ids(store.table("users", open_ended=True).current(NOW))

    add_file(incoming, "1.json", [*EVENTS[:5], {"source": None}])
    run()
    assert current() == ["1", "2", "3"]
    add_file(incoming, "2.json", [*EVENTS[5:], EVENTS[0]])  # one event delivered again
    run()
    assert current() == ["1", "2", "4"]
    assert store.table("users", open_ended=True).all_versions().where("_id = '3'").count() == 1
    assert store.txs().count() == 2
    rejects = spark.read.parquet(f"{store.root}/rejects")
    assert [r["reject_reason"] for r in rejects.collect()] == ["no source"]
    seen = cdc_stream.monitor_log(store).orderBy("_tx").collect()
    assert [(r["current_count"], r["change"]) for r in seen] == [(3, 3), (3, 0)]
    # The event delivered again is a later write from its own time on, so it replaced
    # user 1's update; ``without_redelivered`` is there to prevent that.
    assert seen[1]["newest"] == ["4", "2", "3"]

    # A batch that ran but was not recorded by the stream runs again: nothing doubles.
    batch = spark.createDataFrame(
        [(i, json.dumps(e)) for i, e in enumerate([*EVENTS[5:], EVENTS[0]])],
        "_position bigint, event string")
    store.write_routed(1, cdc.to_log(cdc.normalise(batch, NOW), 1, NOW))
    store.commit(1, datetime(2024, 6, 1))
    assert store.txs().count() == 2
    assert store.raw_log("users").count() == 4 + 4


def test_uncommitted_batch_is_invisible(spark, tmp_path):
    store = LogStore(spark, str(tmp_path / "store"))
    good = cdc.normalise(frame(spark, EVENTS[:2]), NOW)
    store.write_routed(0, cdc.to_log(good, 0, NOW))
    store.commit(0, datetime(2024, 6, 1))
    store.write_routed(1, cdc.to_log(cdc.normalise(frame(spark, EVENTS[2:3]), NOW), 1, NOW))
    assert ids(store.table("users").current(NOW)) == ["1", "2"]


def test_redelivered_events_are_dropped_and_late_ones_kept(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    stream = spark.readStream.schema("k int, t timestamp").json(str(incoming))

    def run(name, lines):
        (incoming / name).write_text("\n".join(map(json.dumps, lines)))
        query = cdc_stream.without_redelivered(stream, ["k"], "1 hour").writeStream.format("parquet").option(
            "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()

    run("a.json", [{"k": 1, "t": "2024-01-01T00:00:00Z"}, {"k": 1, "t": "2024-01-01T00:00:05Z"}, {"k": 2, "t": "2024-01-01T00:00:01Z"}])
    run("b.json", [{"k": 3, "t": "2030-01-01T00:00:00Z"}])
    run("c.json", [{"k": 4, "t": "1999-01-01T00:00:00Z"}, {"k": 1, "t": "2024-01-01T00:00:00Z"}])
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 4]


def state_event(k, name, ms):
    return {"op": "u", "source": {"table": "accounts", "ts_ms": ms}, "before": {"id": k}, "after": {"id": k, "name": name}}


@pytest.mark.parametrize("streamed", [False, True])
def test_newer_and_larger_file_wins(spark, tmp_path, streamed):
    """Blocks reach tasks by size; the order of events is that of file time and place."""
    incoming = tmp_path / "in"
    incoming.mkdir()
    old = [state_event(k, "old", 1000) for k in range(5)]
    new = [state_event(k % 5, f"new{k}", 1000) for k in range(400)]
    for stamp, (name, events) in enumerate({"z.json": old, "a.json": new}.items()):
        (incoming / name).write_text("\n".join(map(json.dumps, events)))
        os.utime(incoming / name, (1_700_000_000 + stamp, 1_700_000_000 + stamp))
    if streamed:
        store = LogStore(spark, str(tmp_path / "store"))
        cdc_stream.apply(cdc_stream.from_files(spark, str(incoming)), store, str(tmp_path / "check")).awaitTermination()
        table = store.table("accounts", open_ended=True)
    else:
        log = cdc.to_log(cdc.normalise(cdc.read_lines(spark, str(incoming)), NOW), 0, NOW)
        table = VersionedTable(cdc.route(log, "accounts"), open_ended=True)
    names = {r["_id"]: r["name"] for r in table.current(NOW).selectExpr("_id", "try_variant_get(doc, '$.name', 'string') as name").collect()}
    assert names == {str(k): f"new{395 + k}" for k in range(5)}

"""Statements on logs, transactions and the store."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dml, reports, travel
from tidemark.operators.travel import VersionedTable
from tidemark.sources.store import LogStore


def day(n, hour=0):
    return datetime(2024, 1, n, hour)


def products(spark, *rows):
    return spark.createDataFrame(list(rows), "_id int, name string, price double")


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()),
                  key=lambda row: [(v is None, v) for v in row])


def test_update_makes_a_second_version(spark):
    log = dml.put(products(spark, (1, "Anchor", 12.5)), 1, day(1))
    change = dml.update(log, {"price": F.lit(14.25)}, 2, day(2), F.col("_id") == 1, open_ended=True)
    table = VersionedTable(dml.append(log, change), open_ended=True)
    assert rows(table.current(day(3)), "name", "price") == [("Anchor", 14.25)]
    assert rows(table.all_versions(), "price", "_valid_from", "_valid_to") == [
        (12.5, day(1), day(2)), (14.25, day(2), None)]
    assert travel.hide_temporal(table.all_versions()).columns == ["_id", "name", "price"]


def test_update_splits_bounded_portion(spark):
    log = dml.put(products(spark, (1, "Anchor", 10.0)), 1, day(1))
    change = dml.update(log, {"price": F.col("price") * 2}, 2, day(5), until=day(8))
    got = rows(VersionedTable(dml.append(log, change)).all_versions(),
               "_valid_from", "_valid_to", "price")
    assert got == [(day(1), day(5), 10.0), (day(5), day(8), 20.0), (day(8), None, 10.0)]


def test_update_keeps_future_versions_apart(spark):
    log = dml.append(
        dml.put(products(spark, (1, "a", 1.0)), 1, day(1)),
        dml.put(products(spark, (1, "b", 5.0)), 2, day(1), valid_from=day(10)))
    change = dml.update(log, {"price": F.col("price") + 100}, 3, day(4))
    got = rows(VersionedTable(dml.append(log, change)).all_versions(),
               "_valid_from", "_valid_to", "name", "price")
    assert got == [
        (day(1), day(4), "a", 1.0), (day(4), day(10), "a", 101.0), (day(10), None, "b", 105.0)]


def test_delete_and_history(spark):
    log = dml.put(products(spark, (1, "x", 1.0), (2, "y", 2.0)), 1, day(1))
    ids = spark.createDataFrame([(1,)], "_id int")
    table = VersionedTable(dml.append(log, dml.delete_ids(ids, 2, day(2))), open_ended=True)
    assert rows(table.current(day(3)), "_id") == [(2,)]
    assert rows(table.deleted_ids(day(3)), "_id") == [(1,)]
    assert rows(table.closed_versions(), "_id", "_valid_to") == [(1, day(2))]
    where = dml.delete_where(log, F.col("price") > 1.5, 2, day(2), open_ended=True)
    assert rows(VersionedTable(dml.append(log, where)).current(day(3)), "_id") == [(1,)]


def test_erase_removes_all_history(spark):
    log = dml.put(products(spark, (1, "x", 1.0), (2, "y", 2.0)), 1, day(1))
    log = dml.append(log, dml.update(log, {"price": F.lit(9.0)}, 2, day(2), F.col("_id") == 1))
    gone = dml.erase(spark.createDataFrame([(1,)], "_id int"), 3)
    table = VersionedTable(log, erasures=gone)
    assert rows(table.all_versions(), "_id") == [(2,)]
    # The basis before the erasure still sees the record; a later put brings it back.
    assert (1,) in rows(table.at_basis(2).all_versions(), "_id")
    back = dml.append(log, dml.put(products(spark, (1, "again", 3.0)), 4, day(5)))
    assert rows(VersionedTable(back, erasures=gone).all_versions(), "_id", "name") == [
        (1, "again"), (2, "y")]


def test_patch_keeps_other_keys_and_creates(spark):
    log = dml.put(spark.createDataFrame(
        [("joe", "Joe", "tea")], "_id string, name string, drinks string"), 1, day(1))
    patches = spark.createDataFrame(
        [("joe", "chocolate", None, ["likes"]), ("ann", "cake", None, ["likes", "drinks"])],
        "_id string, likes string, drinks string, keys array<string>")
    change = dml.patch(log, patches, 2, day(2), provided="keys")
    got = rows(VersionedTable(dml.append(log, change)).current(day(3)),
               "_id", "name", "drinks", "likes")
    assert got == [("ann", None, None, "cake"), ("joe", "Joe", "tea", "chocolate")]


def test_patch_with_null_overwrites(spark):
    log = dml.put(spark.createDataFrame([("joe", "tea")], "_id string, drinks string"), 1, day(1))
    patches = spark.createDataFrame([("joe", None)], "_id string, drinks string")
    change = dml.patch(log, patches, 2, day(2))
    assert rows(VersionedTable(dml.append(log, change)).current(day(3)), "_id", "drinks") == [
        ("joe", None)]


def test_patch_fills_a_gap_only_with_given_keys(spark):
    log = dml.append(
        dml.put(products(spark, (1, "old", 1.0)), 1, day(1), valid_to=day(4)),
        dml.put(products(spark, (1, "new", 2.0)), 2, day(1), valid_from=day(8)))
    patches = spark.createDataFrame([(1, 7.0)], "_id int, price double")
    got = rows(VersionedTable(dml.append(log, dml.patch(log, patches, 3, day(2)))).all_versions(),
               "_valid_from", "_valid_to", "name", "price")
    assert got == [
        (day(1), day(2), "old", 1.0), (day(2), day(4), "old", 7.0), (day(4), day(8), None, 7.0),
        (day(8), None, "new", 7.0)]


def test_patch_of_versions_before_1970(spark):
    early = [datetime(y, 1, 1) for y in (1950, 1955, 1960)]
    log = dml.append(*[dml.put(products(spark, (1, f"v{k}", 1.0)), k + 1, t) for k, t in enumerate(early)])
    patches = spark.createDataFrame([(1, 7.0)], "_id int, price double")
    table = VersionedTable(dml.append(log, dml.patch(log, patches, 9, datetime(1952, 1, 1))))
    got = rows(table.all_versions(), "_valid_from", "_valid_to", "name", "price")
    at = [datetime(1950, 1, 1), datetime(1952, 1, 1), datetime(1955, 1, 1), datetime(1960, 1, 1), None]
    assert got == list(zip(at, at[1:], ["v0", "v0", "v1", "v2"], [1.0, 7.0, 7.0, 7.0]))


def test_record_brings_its_own_valid_from(spark):
    users = spark.createDataFrame(
        [("alice", datetime(2020, 1, 15)), ("bob", None)], "_id string, _valid_from timestamp_ntz")
    table = VersionedTable(dml.put(users, 1, day(1)), open_ended=True)
    assert rows(table.as_of(datetime(2019, 12, 31)), "_id") == []
    assert rows(table.as_of(datetime(2020, 2, 1)), "_id") == [("alice",)]
    assert len(rows(table.as_of(day(2)), "_id")) == 2


def test_several_instants_in_one_pass(spark):
    log = dml.append(
        dml.put(products(spark, (1, "a", 1.0)), 1, day(1)),
        dml.put(products(spark, (1, "a", 2.0)), 2, day(5)))
    found = travel.at_instants(
        VersionedTable(log, open_ended=True).all_versions(), [day(1), day(4), day(5), day(9)])
    assert rows(found, "as_of", "price") == [
        (day(1), 1.0), (day(4), 1.0), (day(5), 2.0), (day(9), 2.0)]


def test_chain_of_statements_settles_between(spark):
    table = VersionedTable(dml.put(products(spark, (1, "a", 1.0)), 1, day(1)), open_ended=True)
    for n in range(2, 7):
        table = table.update({"price": F.col("price") * 2}, n, day(n)).settled()
    assert rows(table.all_versions(), "_valid_from", "price") == [
        (day(n), 2.0 ** (n - 1)) for n in range(1, 7)]
    assert table.log.count() == 6


def test_snapshot_applies_one_time_to_all_tables(spark):
    log = dml.append(
        dml.put(products(spark, (1, "a", 1.0)), 1, day(1)),
        dml.put(products(spark, (1, "a", 2.0)), 2, day(5)))
    table = VersionedTable(log, open_ended=True)
    travel.Snapshot({"p1": table, "p2": table}, day(3)).register(spark)
    got = spark.sql("SELECT p1.price, p2.price FROM p1 JOIN p2 USING (_id)").collect()
    assert [tuple(r) for r in got] == [(1.0, 1.0)]


def test_drift_compounds(spark):
    first = VersionedTable(dml.put(
        spark.createDataFrame([(1, 100.0)], "_id int, bal double"), 1, day(1)), open_ended=True)
    drifted = reports.drift(
        first, [day(1), day(2), day(3)], lambda n: {"bal": F.col("bal") + 100.0 * n}, 0)
    table = VersionedTable(dml.append(first.log, drifted), open_ended=True)
    assert rows(table.all_versions(), "_valid_from", "bal") == [
        (day(1), 100.0), (day(2), 300.0), (day(3), 600.0)]


# -- store ---------------------------------------------------------------------------

@pytest.fixture
def store(spark, tmp_path):
    return LogStore(spark, str(tmp_path / "store"))


def test_commit_rollback_and_error(spark, store):
    tx = store.transact(day(1), {"t": dml.put(products(spark, (1, "kept", 1.0)), 0, day(1))})
    assert tx == 0
    # Staged and never committed: rolled back.
    store.write_rows(1, "t", dml.put(products(spark, (2, "lost", 2.0)), 1, day(2)))
    assert rows(store.table("t").current(day(9)), "_id") == [(1,)]
    assert store.staged("t") == [1]
    # A failing later statement leaves the earlier one of its transaction invisible.
    with pytest.raises(Exception, match="boom"):
        store.transact(day(2), {
            "t": dml.put(products(spark, (3, "half", 3.0)), 1, day(2)),
            "u": dml.put(products(spark, (1, "x", 1.0)).withColumn(
                "name", F.raise_error(F.lit("boom")).cast("string")), 1, day(2))}, tx=1)
    assert rows(store.table("t").current(day(9)), "_id") == [(1,)]
    # The next transaction reuses the number and overwrites the leftovers.
    assert store.next_tx() == 1
    store.transact(day(3), {"t": dml.put(products(spark, (4, "next", 4.0)), 1, day(3))})
    assert rows(store.table("t").current(day(9)), "_id") == [(1,), (4,)]
    assert rows(store.txs(), "_tx", "system_time") == [(0, day(1)), (1, day(3))]


def test_many_tables_share_a_transaction_and_new_columns_appear(spark, store):
    store.transact(day(1), {
        "a": dml.put(products(spark, (1, "x", 1.0)), 0, day(1)),
        "b": dml.put(products(spark, (1, "y", 1.0)), 0, day(1))})
    wider = products(spark, (2, "z", 2.0)).withColumn("color", F.lit("red"))
    store.transact(day(2), {"a": dml.put(wider, 1, day(2))})
    assert rows(store.table("a").current(day(3)), "_id", "color") == [(1, None), (2, "red")]
    assert rows(store.table("a", basis=0).current(day(3)), "_id") == [(1,)]
    assert store.table("a").open_ended
    store.transact(day(3), {"b": dml.put(products(spark, (2, "w", 1.0)), 2, day(3), valid_to=day(9))})
    assert not store.table("b").open_ended
    assert rows(store.list_tables(), "table_name") == [("a",), ("b",)]


def test_rewrite_drops_erased_and_uncommitted_rows(spark, store):
    store.transact(day(1), {"t": dml.put(products(spark, (1, "x", 1.0), (2, "y", 2.0)), 0, day(1))})
    store.write_rows(7, "t", dml.put(products(spark, (9, "never", 0.0)), 7, day(1)))
    store.write_erasures(1, "t", spark.createDataFrame([(1,)], "_id int"))
    assert len(rows(store.table("t").all_versions(), "_id")) == 2  # not committed yet
    store.commit(1, day(2))
    assert rows(store.table("t").all_versions(), "_id") == [(2,)]
    assert store.rewrite("t") == 1
    assert rows(store.raw_log("t"), "_id") == [(2,)] and store.staged("t") == []
    store.transact(day(3), {"t": dml.put(products(spark, (3, "z", 3.0)), 2, day(3))}, tx=2)
    assert rows(store.table("t").current(day(4)), "_id") == [(2,), (3,)]

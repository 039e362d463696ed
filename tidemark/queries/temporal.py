"""Reading versioned tables."""

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.columns import ID, TX, VALID_FROM, VALID_TO
from tidemark.operators import travel
from tidemark.operators.travel import VersionedTable
from tidemark.plans import visibility
from tidemark.queries import logs
from tidemark.queries.logs import (
    EVENTS_SQL, LATE_SQL, PORTION_SQL, as_of_sql, versions_sql,
)
from tidemark.queries.registry import query

NOW = "2024-02-01 00:00:00"
EARLY = "2024-01-10 00:00:00"
LATER = "2024-01-20 12:00:00"
STATE = "SELECT _id, event_type, value FROM state"
HISTORY = "SELECT _id, event_type, value, _valid_from, _valid_to FROM versions"


def history(df):
    return df.select(ID, "event_type", "value", VALID_FROM, VALID_TO)


@query(as_of_sql(EVENTS_SQL, NOW, STATE))
def current_state(spark, sf_dir):
    return logs.events_log(spark, sf_dir).columns("event_type", "value").current(NOW)


@query(as_of_sql(EVENTS_SQL, EARLY, STATE))
def valid_as_of(spark, sf_dir, instant=EARLY):
    return logs.events_log(spark, sf_dir).columns("event_type", "value").as_of(instant)


@query(as_of_sql(LATE_SQL, LATER, STATE))
def late_arrival_as_of(spark, sf_dir, instant=LATER):
    return logs.late_log(spark, sf_dir).columns("event_type", "value").as_of(instant)


@query(versions_sql(EVENTS_SQL, HISTORY))
def all_versions(spark, sf_dir):
    return history(logs.events_log(spark, sf_dir).columns("event_type", "value").all_versions())


@query(versions_sql(LATE_SQL, HISTORY))
def late_arrival_versions(spark, sf_dir):
    return history(logs.late_log(spark, sf_dir).columns("event_type", "value").all_versions())


@query(versions_sql(PORTION_SQL, HISTORY))
def portion_split(spark, sf_dir):
    return history(logs.portion_log(spark, sf_dir).columns("event_type", "value").all_versions())


@query(versions_sql(LATE_SQL, f"""{HISTORY} WHERE _valid_from < TIMESTAMP '{LATER}'
  AND (_valid_to IS NULL OR _valid_to > TIMESTAMP '{EARLY}')"""))
def valid_from_to(spark, sf_dir):
    table = logs.late_log(spark, sf_dir).columns("event_type", "value")
    return history(table.between(EARLY, LATER))


@query(f"""WITH e_log AS ({EVENTS_SQL}), l_log AS ({LATE_SQL}),
  {logs.as_of_cte('e_log', 'e', LATER)}, {logs.as_of_cte('l_log', 'l', LATER)}
  SELECT e._id, e.event_type, l.event_type AS late_type FROM e JOIN l ON e._id = l._id""")
def default_valid_time(spark, sf_dir, instant=LATER):
    state = travel.Snapshot(
        {"on_time": logs.events_log(spark, sf_dir).columns("event_type"),
         "late": logs.late_log(spark, sf_dir).columns("event_type")}, instant)
    late = state["late"].withColumnRenamed("event_type", "late_type")
    return state["on_time"].join(late, ID)


@query(as_of_sql(f"SELECT * FROM ({LATE_SQL}) WHERE _tx <= 500000", LATER, STATE))
def system_as_of(spark, sf_dir, basis=500_000):
    table = logs.late_log(spark, sf_dir).columns("event_type", "value")
    return table.at_basis(basis).as_of(LATER)


CLOCK = "TIMESTAMP '2024-01-01 00:00:00' + to_seconds(_tx)"


@query(as_of_sql(
    f"SELECT * FROM ({LATE_SQL}) WHERE {CLOCK} <= TIMESTAMP '2024-01-05 00:00:00'", LATER, STATE))
def system_as_of_time(spark, sf_dir, instant=datetime(2024, 1, 5)):
    """Transactions are a second apart; the basis is given as an instant."""
    table = logs.late_log(spark, sf_dir).columns("event_type", "value")
    clock = table.log.select(TX).distinct().withColumn(
        "system_time", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, _tx)"))
    return replace(table, clock=clock.withColumn("committed", F.lit(True))).at_basis_time(instant).as_of(LATER)


@query(versions_sql(LATE_SQL, """SELECT _id, _valid_from, _valid_to,
  CAST(date_diff('second', _valid_from, _valid_to) AS BIGINT) >= 86400 AS over_a_day FROM versions"""))
def version_intervals(spark, sf_dir):
    found = logs.late_log(spark, sf_dir).columns().all_versions()
    seconds = F.unix_timestamp(VALID_TO) - F.unix_timestamp(VALID_FROM)
    return found.select(ID, VALID_FROM, VALID_TO, (seconds >= 86400).alias("over_a_day"))


@query(versions_sql(EVENTS_SQL, """SELECT _id, event_type, _valid_from,
  CASE WHEN _valid_to IS NULL THEN 'CURRENT' ELSE 'SUPERSEDED' END AS status FROM versions"""))
def version_status(spark, sf_dir):
    found = logs.events_log(spark, sf_dir).columns("event_type").all_versions()
    return travel.with_status(found).select(ID, "event_type", VALID_FROM, "status")


@query(versions_sql(EVENTS_SQL, f"{HISTORY} WHERE _valid_to IS NOT NULL"))
def closed_versions(spark, sf_dir):
    return history(logs.events_log(spark, sf_dir).columns("event_type", "value").closed_versions())


@query(as_of_sql(EVENTS_SQL, NOW, """SELECT DISTINCT _id FROM log WHERE _op = 'put'
  AND _id NOT IN (SELECT _id FROM state)"""))
def deleted_records(spark, sf_dir):
    return logs.events_log(spark, sf_dir).deleted_ids(NOW)


@query(versions_sql(EVENTS_SQL, """SELECT _id, _valid_from,
  CASE WHEN phone IS NULL THEN 'Before ALTER TABLE' ELSE 'After ALTER TABLE' END AS schema_version
  FROM (SELECT *, CASE WHEN _valid_from >= TIMESTAMP '2024-01-15' THEN props END AS phone
        FROM versions)"""))
def schema_generation(spark, sf_dir):
    """A column that appears mid-way: earlier writes lack it and read as NULL."""
    table = logs.events_log(spark, sf_dir)
    added = F.col(VALID_FROM) >= F.lit("2024-01-15").cast("timestamp_ntz")
    old = table.log.where(~added).drop("props")
    new = table.log.where(added)
    evolved = VersionedTable(old.unionByName(new, allowMissingColumns=True), open_ended=True)
    label = F.when(F.col("props").isNull(), "Before ALTER TABLE").otherwise("After ALTER TABLE")
    return evolved.columns("props").all_versions().select(
        ID, VALID_FROM, label.alias("schema_version"))


@query(as_of_sql(
    f"""SELECT * FROM ({EVENTS_SQL}) WHERE _tx IN (SELECT event_id FROM events WHERE value >= 10)""",
    LATER, STATE))
def committed_only(spark, sf_dir):
    """Transactions that never reached the transaction table leave nothing visible."""
    table = logs.events_log(spark, sf_dir).columns("event_type", "value")
    txs = logs.table(spark, sf_dir, "events").select(
        F.col("event_id").alias(TX), F.col("ts").alias("system_time"),
        (F.col("value") >= 10).alias("committed"))
    return VersionedTable(visibility.committed(table.log, txs), open_ended=True).as_of(LATER)

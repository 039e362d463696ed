"""Statements that write, shown through the versions they leave."""

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.columns import ID, VALID_FROM, VALID_TO
from tidemark.operators import dml
from tidemark.operators.travel import VersionedTable
from tidemark.plans import visibility
from tidemark.queries import logs
from tidemark.queries.logs import EVENTS_SQL, as_of_cte, versions_ctes
from tidemark.queries.registry import query
from tidemark.queries.temporal import NOW, history

# After every transaction number the events log uses.
TX_AFTER = 10**15
AT = "2024-01-15 00:00:00"
LOG = f"log AS (SELECT * EXCLUDE props FROM ({EVENTS_SQL}))"
HISTORY = "SELECT _id, event_type, value, _valid_from, _valid_to FROM v2"
STATE = "SELECT _id, event_type, value FROM state"
COLUMNS = "_id, _valid_from, _valid_to, _tx, _seq, _op, event_type, value"
CLIPPED = f"""clipped AS (
  SELECT * REPLACE (greatest(_valid_from, TIMESTAMP '{AT}') AS _valid_from) FROM v1
  WHERE _valid_to IS NULL OR _valid_to > TIMESTAMP '{AT}')"""


def _table(spark, sf_dir):
    return logs.events_log(spark, sf_dir).columns("event_type", "value")


def _totals(spark, sf_dir):
    """A fresh record per user: the greatest value seen."""
    events = logs.table(spark, sf_dir, "events")
    return events.groupBy(F.col("user_id").alias(ID)).agg(
        F.lit("total").alias("event_type"), F.max("value").alias("value"))


def _put_sql(start: str, end: str = "NULL") -> str:
    return f"""SELECT user_id AS _id, TIMESTAMP '{start}' AS _valid_from,
      CAST({end} AS TIMESTAMP) AS _valid_to, {TX_AFTER} AS _tx, 0 AS _seq, 'put' AS _op,
      'total' AS event_type, max(value) AS value FROM events GROUP BY user_id"""


def _with_log2(more: str, then: str, before: str = "") -> str:
    return f"""WITH {LOG}, {before} log2 AS (SELECT {COLUMNS} FROM log UNION ALL
      SELECT {COLUMNS} FROM ({more})), {then}"""


@query(_with_log2(_put_sql(NOW), f"{as_of_cte('log2', 'state', NOW)} {STATE}"))
def put_upsert(spark, sf_dir):
    table = _table(spark, sf_dir)
    rows = dml.put(_totals(spark, sf_dir), TX_AFTER, NOW, distinct_ids=True)
    return table.after_puts(rows).current(NOW)


@query(_with_log2(_put_sql("2024-01-05 00:00:00"), f"{versions_ctes('log2', 'v2')} {HISTORY}"))
def put_backdated(spark, sf_dir):
    table = _table(spark, sf_dir)
    rows = dml.put(_totals(spark, sf_dir), TX_AFTER, NOW, valid_from="2024-01-05 00:00:00", distinct_ids=True)
    return history(table.after_puts(rows).all_versions())


@query(_with_log2(_put_sql("2024-03-01 00:00:00"), f"""{as_of_cte('log2', 'n', NOW)},
  {as_of_cte('log2', 'f', '2024-03-02 00:00:00')}
  SELECT 'now' AS at, _id, event_type, value FROM n
  UNION ALL SELECT 'future', _id, event_type, value FROM f"""))
def future_version(spark, sf_dir):
    table = _table(spark, sf_dir)
    rows = dml.put(_totals(spark, sf_dir), TX_AFTER, NOW, valid_from="2024-03-01 00:00:00", distinct_ids=True)
    after = table.after_puts(rows)
    now = after.current(NOW).withColumn("at", F.lit("now"))
    return now.unionByName(after.as_of("2024-03-02 00:00:00").withColumn("at", F.lit("future")))


_UPDATE_SQL = f"""SELECT * REPLACE ({TX_AFTER} AS _tx, epoch_us(_valid_from) AS _seq,
  value * 2 AS value) FROM clipped WHERE event_type = 'purchase'"""


@query(_with_log2(_UPDATE_SQL, f"{versions_ctes('log2', 'v2')} {HISTORY}",
                  f"{versions_ctes('log', 'v1')}, {CLIPPED},"))
def update_expr(spark, sf_dir):
    table = _table(spark, sf_dir)
    after = table.update(
        {"value": F.col("value") * 2}, TX_AFTER, AT, where=F.col("event_type") == "purchase")
    return history(after.all_versions())


@query(_with_log2(
    f"""SELECT * REPLACE ({TX_AFTER} AS _tx, epoch_us(_valid_from) AS _seq, 'delete' AS _op)
    FROM clipped WHERE event_type = 'click'""",
    f"{versions_ctes('log2', 'v2')} {HISTORY}", f"{versions_ctes('log', 'v1')}, {CLIPPED},"))
def soft_delete(spark, sf_dir):
    table = _table(spark, sf_dir)
    after = table.delete_where(F.col("event_type") == "click", TX_AFTER, AT)
    return history(after.all_versions())


@query(_with_log2(
    f"""SELECT DISTINCT user_id AS _id, TIMESTAMP '2024-01-25' AS _valid_from,
    CAST(NULL AS TIMESTAMP) AS _valid_to, {TX_AFTER} AS _tx, 0 AS _seq, 'delete' AS _op,
    NULL AS event_type, NULL AS value FROM events WHERE event_type = 'signup' AND value > 80""",
    f"{versions_ctes('log2', 'v2')} {HISTORY}"))
def delete_portion(spark, sf_dir):
    table = _table(spark, sf_dir)
    ids = logs.table(spark, sf_dir, "events").where(
        "event_type = 'signup' AND value > 80").select(F.col("user_id").alias(ID))
    rows = dml.delete_ids(ids, TX_AFTER, NOW, valid_from="2024-01-25 00:00:00")
    return history(table.after_puts(rows).all_versions())


@query(_with_log2(
    f"""SELECT DISTINCT user_id AS _id, TIMESTAMP '2024-01-08' AS _valid_from,
    TIMESTAMP '2024-01-12' AS _valid_to, {TX_AFTER} AS _tx, 0 AS _seq, 'delete' AS _op,
    NULL AS event_type, NULL AS value FROM events WHERE event_type = 'purchase'""",
    f"{versions_ctes('log2', 'v2')} {HISTORY}"))
def delete_bounded_portion(spark, sf_dir):
    table = _table(spark, sf_dir)
    ids = logs.table(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        F.col("user_id").alias(ID))
    rows = dml.delete_ids(ids, TX_AFTER, NOW, "2024-01-08 00:00:00", "2024-01-12 00:00:00")
    return history(replace(table.after_puts(rows), open_ended=False).all_versions())


@query(f"""WITH {LOG}, kept AS (SELECT * FROM log WHERE _id NOT IN (
    SELECT user_id FROM events WHERE event_type = 'error' AND value > 95)),
  {versions_ctes('kept', 'v2')} {HISTORY}""")
def erase(spark, sf_dir):
    table = _table(spark, sf_dir)
    ids = logs.table(spark, sf_dir, "events").where(
        "event_type = 'error' AND value > 95").select(F.col("user_id").alias(ID))
    erased = visibility.without_erased(table.log, dml.erase(ids, TX_AFTER))
    return history(VersionedTable(erased, open_ended=True).all_versions())


@query(f"""WITH {LOG}, {versions_ctes('log', 'v1')}, {CLIPPED},
  patches AS (SELECT c_custkey AS _id, c_mktsegment AS event_type FROM customer),
  log2 AS (SELECT {COLUMNS} FROM log
    UNION ALL SELECT _id, TIMESTAMP '{AT}', NULL, {TX_AFTER}, -1, 'put', event_type, NULL FROM patches
    UNION ALL SELECT c._id, _valid_from, _valid_to, {TX_AFTER}, epoch_us(_valid_from), 'put',
      p.event_type, c.value FROM clipped c JOIN patches p ON c._id = p._id),
  {versions_ctes('log2', 'v2')} {HISTORY}""")
def patch_merge(spark, sf_dir):
    """Customers' segments patched into user states; unknown ids become records."""
    table = _table(spark, sf_dir)
    patches = logs.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(ID), F.col("c_mktsegment").alias("event_type"))
    return history(table.patch(patches, TX_AFTER, AT).all_versions())


@query(f"""WITH log AS ({logs.ORDERS_INITIAL_SQL}), log2 AS (
    SELECT _id, _valid_from, _valid_to, _tx, _seq, _op, o_orderstatus, o_totalprice FROM log
    UNION ALL SELECT _id, TIMESTAMP '2002-01-01', NULL, 2, 0, 'put', 'F',
      o_totalprice * CAST(1.05 AS DOUBLE) FROM log WHERE o_orderstatus = 'P'),
  {versions_ctes('log2', 'v2')}
  SELECT _id, o_orderstatus, o_totalprice, _valid_from, _valid_to FROM v2""")
def insert_select_versions(spark, sf_dir, at="2002-01-01 00:00:00"):
    table = logs.orders_initial(spark, sf_dir).columns("o_orderstatus", "o_totalprice")
    pending = table.as_of(at).where("o_orderstatus = 'P'").withColumns({
        "o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") * 1.05})
    log = dml.append(table.log, dml.put(pending, 2, at, distinct_ids=True))
    return VersionedTable(log, open_ended=True).all_versions().select(
        ID, "o_orderstatus", "o_totalprice", VALID_FROM, VALID_TO)


_REPEATED_SQL = """SELECT user_id AS _id, {start} AS _valid_from, {end} AS _valid_to, {tx} AS _tx,
  row_number() OVER (PARTITION BY user_id ORDER BY {order} event_type, value NULLS FIRST) - 1 AS _seq, 'put' AS _op, event_type, value FROM events"""


@query(f"""SELECT _id, event_type, value FROM ({_REPEATED_SQL.format(start=f"TIMESTAMP '{NOW}'", end="NULL", tx=TX_AFTER, order="")})
  QUALIFY row_number() OVER (PARTITION BY _id ORDER BY _seq DESC) = 1""")
def put_repeated_ids(spark, sf_dir):
    """One transaction with many records of each id: one of them wins, whatever the order of rows."""
    records = logs.table(spark, sf_dir, "events").select(F.col("user_id").alias(ID), "event_type", "value")
    return VersionedTable(dml.put(records, TX_AFTER, NOW), open_ended=True).current(NOW)


@query(f"""WITH log2 AS ({_REPEATED_SQL.format(
    start="date_trunc('day', ts)", end="date_trunc('day', ts) + INTERVAL 2 DAY", tx=TX_AFTER, order="date_trunc('day', ts),")}),
  {versions_ctes('log2', 'v2')} {HISTORY}""")
def portion_split_ties(spark, sf_dir):
    """One transaction with many records of each id for two days each, of which many start at the same instant."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    records = logs.table(spark, sf_dir, "events").select(
        F.col("user_id").alias(ID), day.alias(VALID_FROM), (day + F.expr("INTERVAL 2 DAY")).alias(VALID_TO), "event_type", "value")
    return history(VersionedTable(dml.put(records, TX_AFTER, NOW)).all_versions())

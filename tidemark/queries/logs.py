"""The given tables as write logs, for Spark and as SQL text.

``events`` is a log of user states: an error ends the state.  It also comes with
shuffled commit order (late arrivals) and with bounded periods.  Orders and line
items start as one write each and get later corrections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.columns import (
    DELETE, ID, LOG_COLUMNS, OP, PUT, SEQ, SYSTEM_FROM, TX, VALID_FROM, VALID_TO,
)
from tidemark.operators.travel import VersionedTable
from tidemark.plans.skew import profile


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _log(df: DataFrame, key: Column, start: Column, tx: Column, seq: Column, op: Column,
         *payload: str, end: Column | None = None) -> DataFrame:
    stamped = df.withColumns({
        ID: key, VALID_FROM: start,
        VALID_TO: F.lit(None).cast("timestamp_ntz") if end is None else end,
        TX: tx.cast("bigint"), SEQ: seq.cast("bigint"), SYSTEM_FROM: start, OP: op})
    return stamped.select(*LOG_COLUMNS, *payload)


EVENT_PAYLOAD = ("event_type", "value", "props")


def _event_op() -> Column:
    return F.when(F.col("event_type") == "error", DELETE).otherwise(PUT)


def events_log(spark, sf_dir) -> VersionedTable:
    df = table(spark, sf_dir, "events")
    return VersionedTable(
        _log(df, F.col("user_id"), F.col("ts"), F.col("event_id"), F.lit(0), _event_op(),
             *EVENT_PAYLOAD),
        open_ended=True)


def _late_tx() -> Column:
    return (F.col("event_id") * 7919) % 1000003


def late_log(spark, sf_dir) -> VersionedTable:
    df = table(spark, sf_dir, "events")
    return VersionedTable(
        _log(df, F.col("user_id"), F.col("ts"), _late_tx(), F.col("event_id"), _event_op(),
             *EVENT_PAYLOAD),
        open_ended=True)


def portion_log(spark, sf_dir) -> VersionedTable:
    """Late arrivals where a view speaks for two days only."""
    df = table(spark, sf_dir, "events")
    end = F.when(F.col("event_type") == "view", F.col("ts") + F.expr("INTERVAL 2 DAY"))
    return VersionedTable(
        _log(df, F.col("user_id"), F.col("ts"), _late_tx(), F.col("event_id"), _event_op(),
             *EVENT_PAYLOAD, end=end))


ORDER_PAYLOAD = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
LINE_PAYLOAD = (
    "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")


def line_id() -> Column:
    """Line number and order repeat, so the id takes part, supplier and price as well."""
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)


def orders_initial(spark, sf_dir) -> VersionedTable:
    df = table(spark, sf_dir, "orders")
    return VersionedTable(
        _log(df, F.col("o_orderkey"), F.col("o_orderdate"), F.lit(1), F.lit(0), F.lit(PUT),
             *ORDER_PAYLOAD),
        open_ended=True)


def lines_initial(spark, sf_dir) -> VersionedTable:
    df = table(spark, sf_dir, "lineitem")
    return VersionedTable(
        _log(df, line_id(), F.col("l_shipdate"), F.lit(1), F.lit(0), F.lit(PUT), *LINE_PAYLOAD),
        open_ended=True)


def customers_log(spark, sf_dir) -> VersionedTable:
    """Customers, valid since their first order where they have one."""
    first = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("_since"))
    customer = table(spark, sf_dir, "customer")
    df = customer.join(first, "c_custkey", "left")
    since = F.coalesce("_since", F.expr("timestamp_ntz'1995-01-01 00:00:00'"))
    return VersionedTable(
        _log(df, F.col("c_custkey"), since, F.lit(1), F.lit(0), F.lit(PUT),
             "c_custkey", "c_name", "c_acctbal"),
        open_ended=True, prof=profile(customer.select(F.col("c_custkey").alias(ID))))


def progression(df: DataFrame) -> DataFrame:
    """The second write of open orders: next status, price up by 5 %, 38 hours later."""
    status = F.when(F.col("o_orderstatus") == "O", "P").when(
        F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus"))
    return df.where(F.col("o_orderstatus") != "F").withColumns({
        VALID_FROM: F.col(VALID_FROM) + F.expr("INTERVAL 38 HOUR"),
        "o_orderstatus": status, "o_totalprice": F.col("o_totalprice") * 1.05,
        TX: F.lit(2).cast("bigint")}).withColumn(SYSTEM_FROM, F.col(VALID_FROM))


def orders_log(spark, sf_dir) -> VersionedTable:
    first = orders_initial(spark, sf_dir)
    return first.after(progression(first.log), open_ended=True)


def price_correction(df: DataFrame) -> DataFrame:
    """Returned lines, corrected 64 hours later: price down 5 %, discount capped."""
    return df.where(F.col("l_returnflag") == "R").withColumns({
        VALID_FROM: F.col(VALID_FROM) + F.expr("INTERVAL 64 HOUR"),
        "l_extendedprice": F.col("l_extendedprice") * 0.95,
        "l_discount": F.least(F.col("l_discount") + 0.03, F.lit(0.10)),
        TX: F.lit(2).cast("bigint")}).withColumn(SYSTEM_FROM, F.col(VALID_FROM))


def lines_log(spark, sf_dir) -> VersionedTable:
    first = lines_initial(spark, sf_dir)
    return first.after(price_correction(first.log), open_ended=True)


# -- the same logs and their resolution in SQL --------------------------------------

_EVENT_TAIL = """CASE WHEN event_type = 'error' THEN 'delete' ELSE 'put' END AS _op,
  event_type, value, props FROM events"""
EVENTS_SQL = f"""SELECT user_id AS _id, ts AS _valid_from, CAST(NULL AS TIMESTAMP) AS _valid_to,
  event_id AS _tx, CAST(0 AS BIGINT) AS _seq, {_EVENT_TAIL}"""
LATE_SQL = f"""SELECT user_id AS _id, ts AS _valid_from, CAST(NULL AS TIMESTAMP) AS _valid_to,
  (event_id * 7919) % 1000003 AS _tx, event_id AS _seq, {_EVENT_TAIL}"""
PORTION_SQL = f"""SELECT user_id AS _id, ts AS _valid_from,
  CASE WHEN event_type = 'view' THEN ts + INTERVAL 2 DAY END AS _valid_to,
  (event_id * 7919) % 1000003 AS _tx, event_id AS _seq, {_EVENT_TAIL}"""

ORDERS_INITIAL_SQL = """SELECT o_orderkey AS _id, o_orderdate AS _valid_from,
  CAST(NULL AS TIMESTAMP) AS _valid_to, CAST(1 AS BIGINT) AS _tx, CAST(0 AS BIGINT) AS _seq,
  'put' AS _op, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"""
ORDERS_SQL = f"""{ORDERS_INITIAL_SQL} UNION ALL
  SELECT o_orderkey, o_orderdate + INTERVAL 38 HOUR, NULL, 2, 0, 'put', o_orderkey, o_custkey,
  CASE o_orderstatus WHEN 'O' THEN 'P' WHEN 'P' THEN 'F' ELSE o_orderstatus END,
  o_totalprice * CAST(1.05 AS DOUBLE), o_orderpriority FROM orders WHERE o_orderstatus <> 'F'"""

LINE_ID_SQL = """concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(floor(l_extendedprice * 100 + CAST(0.5 AS DOUBLE)) AS BIGINT))"""
LINES_INITIAL_SQL = f"""SELECT {LINE_ID_SQL} AS _id, l_shipdate AS _valid_from,
  CAST(NULL AS TIMESTAMP) AS _valid_to, CAST(1 AS BIGINT) AS _tx, CAST(0 AS BIGINT) AS _seq,
  'put' AS _op, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag
  FROM lineitem"""
LINES_SQL = f"""{LINES_INITIAL_SQL} UNION ALL
  SELECT {LINE_ID_SQL}, l_shipdate + INTERVAL 64 HOUR, NULL, 2, 0, 'put', l_orderkey,
  l_linenumber, l_quantity, l_extendedprice * CAST(0.95 AS DOUBLE),
  least(l_discount + CAST(0.03 AS DOUBLE), CAST(0.10 AS DOUBLE)), l_returnflag
  FROM lineitem WHERE l_returnflag = 'R'"""
CUSTOMERS_SQL = """SELECT c_custkey AS _id,
  coalesce((SELECT min(o_orderdate) FROM orders WHERE o_custkey = c_custkey),
           TIMESTAMP '1995-01-01') AS _valid_from,
  CAST(NULL AS TIMESTAMP) AS _valid_to, CAST(1 AS BIGINT) AS _tx, CAST(0 AS BIGINT) AS _seq,
  'put' AS _op, c_custkey, c_name, c_acctbal FROM customer"""


def versions_ctes(log: str, name: str) -> str:
    """CTEs that resolve the log CTE ``log`` into ``name`` by replaying every segment."""
    return f"""
{name}_points AS (
  SELECT _id, _valid_from AS t FROM {log}
  UNION SELECT _id, _valid_to FROM {log} WHERE _valid_to IS NOT NULL),
{name}_segments AS (
  SELECT _id, t, lead(t) OVER (PARTITION BY _id ORDER BY t) AS e FROM {name}_points),
{name}_winners AS (
  SELECT w.*, s.t, s.e FROM {name}_segments s JOIN {log} w
    ON w._id = s._id AND w._valid_from <= s.t AND (w._valid_to IS NULL OR w._valid_to > s.t)
  QUALIFY row_number() OVER (PARTITION BY s._id, s.t ORDER BY w._tx DESC, w._seq DESC) = 1),
{name}_marked AS (
  SELECT *, CASE WHEN lag(e) OVER line IS NOT DISTINCT FROM t AND lag(_tx) OVER line = _tx
    AND lag(_seq) OVER line = _seq THEN 0 ELSE 1 END AS starts
  FROM {name}_winners WHERE _op = 'put' WINDOW line AS (PARTITION BY _id ORDER BY t)),
{name}_runs AS (
  SELECT *, sum(starts) OVER (PARTITION BY _id ORDER BY t) AS run FROM {name}_marked),
{name}_edges AS (
  SELECT *, min(t) OVER (PARTITION BY _id, run) AS run_from,
    last_value(e) OVER (PARTITION BY _id, run ORDER BY t
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run_to FROM {name}_runs),
{name} AS (
  SELECT * EXCLUDE (_valid_from, _valid_to, t, e, starts, run, run_from, run_to),
    run_from AS _valid_from, run_to AS _valid_to FROM {name}_edges WHERE t = run_from)"""


def as_of_cte(log: str, name: str, instant: str) -> str:
    """CTE with the rows of the log CTE ``log`` valid at ``instant``."""
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT * FROM {log} WHERE _valid_from <= TIMESTAMP '{instant}'
      AND (_valid_to IS NULL OR _valid_to > TIMESTAMP '{instant}')
    QUALIFY row_number() OVER (PARTITION BY _id ORDER BY _tx DESC, _seq DESC) = 1)
  WHERE _op = 'put')"""


def versions_sql(log_sql: str, select: str) -> str:
    return f"WITH log AS ({log_sql}), {versions_ctes('log', 'versions')} {select}"


def as_of_sql(log_sql: str, instant: str, select: str) -> str:
    return f"WITH log AS ({log_sql}), {as_of_cte('log', 'state', instant)} {select}"

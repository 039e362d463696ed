"""Corrections, progressions and reports over versioned business tables."""

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.columns import ID, VALID_FROM, VALID_TO
from tidemark.operators import dml, reports
from tidemark.operators.travel import Snapshot, VersionedTable
from tidemark.queries import logs
from tidemark.queries.logs import as_of_cte, versions_ctes, versions_sql
from tidemark.queries.registry import query


@query(versions_sql(logs.LINES_SQL, """SELECT _id, l_extendedprice, l_discount, _valid_from,
  _valid_to FROM versions WHERE l_returnflag = 'R'"""))
def late_price_correction(spark, sf_dir):
    table = logs.lines_log(spark, sf_dir).columns("l_extendedprice", "l_discount", "l_returnflag")
    return table.all_versions().where("l_returnflag = 'R'").select(
        ID, "l_extendedprice", "l_discount", VALID_FROM, VALID_TO)


@query(versions_sql(logs.ORDERS_SQL, """SELECT _id, o_orderstatus, o_totalprice, _valid_from,
  _valid_to FROM versions"""))
def order_status_progression(spark, sf_dir):
    table = logs.orders_log(spark, sf_dir).columns("o_orderstatus", "o_totalprice")
    return table.all_versions().select(
        ID, "o_orderstatus", "o_totalprice", VALID_FROM, VALID_TO)


DAYS = tuple(f"2024-03-0{d} 12:00:00" for d in range(1, 8))


def _supplier_days_sql() -> str:
    parts = ["SELECT s_suppkey AS _id, TIMESTAMP '%s' AS _valid_from, CAST(1 AS BIGINT) AS _tx, "
             "s_acctbal FROM supplier" % DAYS[0]]
    balance = "s_acctbal"
    for n, day in enumerate(DAYS[1:], 2):
        balance = f"({balance} + CAST({100 * n} AS DOUBLE))"
        parts.append(f"SELECT s_suppkey, TIMESTAMP '{day}', {n}, {balance} FROM supplier")
    return " UNION ALL ".join(parts)


@query(f"""SELECT _id, s_acctbal, _valid_from, lead(_valid_from) OVER (
  PARTITION BY _id ORDER BY _valid_from) AS _valid_to FROM ({_supplier_days_sql()})""")
def daily_drift(spark, sf_dir):
    supplier = logs.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias(ID), "s_acctbal")
    first = VersionedTable(dml.put(supplier, 1, DAYS[0], distinct_ids=True), open_ended=True)
    rows = reports.drift(
        first, DAYS, lambda n: {"s_acctbal": F.col("s_acctbal") + 100.0 * n}, first_tx=0)
    log = dml.append(first.log, rows)
    return VersionedTable(log, open_ended=True).all_versions().select(
        ID, "s_acctbal", VALID_FROM, VALID_TO)


def _part_days_sql() -> str:
    parts = ["SELECT p_partkey AS _id, TIMESTAMP '%s' AS _valid_from, p_retailprice FROM part" % DAYS[0]]
    price = "p_retailprice"
    for n, day in enumerate(DAYS[1:], 2):
        price = f"({price} * CAST({1 + 0.01 * n!r} AS DOUBLE))"
        parts.append(f"SELECT p_partkey, TIMESTAMP '{day}', {price} FROM part")
    return " UNION ALL ".join(parts)


@query(f"""SELECT _id, p_retailprice AS price, _valid_from, lead(_valid_from) OVER (
  PARTITION BY _id ORDER BY _valid_from) AS _valid_to FROM ({_part_days_sql()})""")
def daily_price_drift(spark, sf_dir):
    part = logs.table(spark, sf_dir, "part").select(F.col("p_partkey").alias(ID), "p_retailprice")
    first = VersionedTable(dml.put(part, 1, DAYS[0], distinct_ids=True), open_ended=True)
    rows = reports.drift(
        first, DAYS, lambda n: {"p_retailprice": F.col("p_retailprice") * (1 + 0.01 * n)}, first_tx=0)
    return VersionedTable(dml.append(first.log, rows), open_ended=True).all_versions().select(
        ID, F.col("p_retailprice").alias("price"), VALID_FROM, VALID_TO)


BILLED_AT = "1999-06-30 23:59:59"
TREND = ("1996-12-31 23:59:59", "1998-06-30 23:59:59", "2000-01-01 00:00:00", "2002-01-01 00:00:00")

_BILLING_MEASURES = """count(DISTINCT o_orderkey) AS order_count, count(l_orderkey) AS line_item_count,
  CAST(round(coalesce(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(24,6))), 0), 2)
    AS DOUBLE) AS total_revenue,
  {price} AS avg_line_price, {discount} AS avg_discount"""


def _mean_sql(column: str) -> str:
    """Average rounded half up to cents in whole numbers, so binary halves cannot differ."""
    millionths = f"CAST(sum(CAST({column} AS DECIMAL(24,6))) * 1000000 AS HUGEINT)"
    n = "nullif(count(l_orderkey), 0)"
    return (f"CAST(coalesce((2 * {millionths} + {n} * 10000) // (2 * {n} * 10000), 0) AS DOUBLE) / 100")


_BILLING_MEASURES = _BILLING_MEASURES.format(
    price=_mean_sql("l_extendedprice"), discount=_mean_sql("l_discount"))


@query(f"""WITH c_log AS ({logs.CUSTOMERS_SQL}), o_log AS ({logs.ORDERS_SQL}),
  l_log AS ({logs.LINES_SQL}), {as_of_cte('c_log', 'c', BILLED_AT)},
  {as_of_cte('o_log', 'o', BILLED_AT)}, {as_of_cte('l_log', 'l', BILLED_AT)}
  SELECT c_custkey, c_name, c_acctbal AS customer_balance, {_BILLING_MEASURES}
  FROM c LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN l ON o_orderkey = l_orderkey
  GROUP BY c_custkey, c_name, c_acctbal""")
def billing_report(spark, sf_dir, instant=BILLED_AT):
    state = Snapshot({
        "customer": logs.customers_log(spark, sf_dir),
        "orders": logs.orders_log(spark, sf_dir).columns("o_orderkey", "o_custkey"),
        "lineitem": logs.lines_log(spark, sf_dir).columns(
            "l_orderkey", "l_extendedprice", "l_discount"),
    }, instant)
    return reports.billing_report(state["customer"], state["orders"], state["lineitem"])


def _trend_sql() -> str:
    instants = ", ".join(f"(TIMESTAMP '{t}')" for t in TREND)
    return f"""WITH moments AS (SELECT * FROM (VALUES {instants}) AS v(as_of)),
      c_log AS ({logs.CUSTOMERS_SQL}), o_log AS ({logs.ORDERS_SQL}), l_log AS ({logs.LINES_SQL}),
      {versions_ctes('c_log', 'cv')}, {versions_ctes('o_log', 'ov')}, {versions_ctes('l_log', 'lv')},
      c AS (SELECT * FROM cv JOIN moments ON _valid_from <= as_of AND (_valid_to IS NULL OR _valid_to > as_of)),
      o AS (SELECT * FROM ov JOIN moments ON _valid_from <= as_of AND (_valid_to IS NULL OR _valid_to > as_of)),
      l AS (SELECT * FROM lv JOIN moments ON _valid_from <= as_of AND (_valid_to IS NULL OR _valid_to > as_of))
      SELECT c.as_of, count(DISTINCT c_custkey) AS customers, {_BILLING_MEASURES}
      FROM c LEFT JOIN o ON c_custkey = o_custkey AND c.as_of = o.as_of
      LEFT JOIN l ON o_orderkey = l_orderkey AND o.as_of = l.as_of GROUP BY c.as_of"""


@query(_trend_sql())
def billing_trend(spark, sf_dir, instants=TREND):
    return reports.billing_trend(
        logs.customers_log(spark, sf_dir), logs.orders_log(spark, sf_dir),
        logs.lines_log(spark, sf_dir), instants)


@query(versions_sql(logs.LINES_SQL, """SELECT _id, l_orderkey, l_linenumber, l_extendedprice,
  l_discount, _valid_from, _valid_to,
  CASE WHEN _valid_to IS NULL THEN 'CURRENT' ELSE 'SUPERSEDED' END AS status FROM versions
  WHERE _valid_from < TIMESTAMP '1996-01-01' ORDER BY _valid_from, _id LIMIT 15"""))
def lineitem_evolution(spark, sf_dir):
    return reports.evolution(
        logs.lines_log(spark, sf_dir),
        ("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"), "1996-01-01", 15)


@query(versions_sql(logs.ORDERS_SQL, """SELECT _id, o_orderkey, o_orderstatus, o_totalprice,
  _valid_from, _valid_to,
  CASE WHEN _valid_to IS NULL THEN 'CURRENT' ELSE 'SUPERSEDED' END AS status FROM versions
  WHERE _valid_from < TIMESTAMP '1996-01-01' ORDER BY _valid_from, _id LIMIT 20"""))
def order_evolution(spark, sf_dir):
    return reports.evolution(
        logs.orders_log(spark, sf_dir), ("o_orderkey", "o_orderstatus", "o_totalprice"),
        "1996-01-01", 20)


CORRECTED_AT = "2024-06-01 00:00:00"
LOADED_AT = "1990-01-01 00:00:00"
RULES = {
    "customer": ("c_custkey", {"c_acctbal": "c_acctbal * 1.05D"}, None),
    "orders": ("o_orderkey", {"o_orderpriority": "'1-URGENT'"}, "o_orderstatus = 'O'"),
    "lineitem": (None, {"l_extendedprice": "l_extendedprice * 0.98D",
                        "l_discount": "least(l_discount + 0.02D, 0.10D)"}, None),
    "supplier": ("s_suppkey", {"s_acctbal": "s_acctbal * 1.03D"}, None),
    "part": ("p_partkey", {"p_retailprice": "p_retailprice * 1.02D"}, None),
    "nation": ("n_nationkey", {"n_name": "n_name || ' [Verified 2024]'"}, None),
    "region": ("r_regionkey", {"r_name": "r_name || ' [Updated]'"}, None),
}
# What the check shows of each table: one number and one text per corrected version.
SHOWN = {
    "customer": ("c_acctbal", "c_name"), "orders": ("o_totalprice", "o_orderpriority"),
    "lineitem": ("l_extendedprice * (1 - l_discount)", "l_returnflag"),
    "supplier": ("s_acctbal", "s_name"), "part": ("p_retailprice", "p_name"),
    "nation": ("CAST(n_regionkey AS DOUBLE)", "n_name"),
    "region": ("CAST(r_regionkey AS DOUBLE)", "r_name"),
}


def _corrections_sql() -> str:
    parts = []
    for name, (key, changes, where) in RULES.items():
        number, text = SHOWN[name]
        ident = f"CAST({key} AS VARCHAR)" if key else logs.LINE_ID_SQL
        replaced = ", ".join(
            "%s AS %s" % (e.replace("1.05D", "CAST(1.05 AS DOUBLE)").replace("0.98D", "CAST(0.98 AS DOUBLE)")
                          .replace("0.02D", "CAST(0.02 AS DOUBLE)").replace("0.10D", "CAST(0.10 AS DOUBLE)")
                          .replace("1.03D", "CAST(1.03 AS DOUBLE)").replace("1.02D", "CAST(1.02 AS DOUBLE)"), c)
            for c, e in changes.items())
        hit = where or "true"
        shown = f"{number} AS number, {text} AS text"
        parts.append(
            f"SELECT '{name}' AS table_name, _id, {shown}, TIMESTAMP '{LOADED_AT}' AS _valid_from, "
            f"CASE WHEN {hit} THEN TIMESTAMP '{CORRECTED_AT}' END AS _valid_to "
            f"FROM (SELECT {ident} AS _id, * FROM {name})")
        parts.append(
            f"SELECT '{name}', _id, {shown}, TIMESTAMP '{CORRECTED_AT}', NULL FROM ("
            f"SELECT * REPLACE ({replaced}) FROM (SELECT {ident} AS _id, * FROM {name}) WHERE {hit})")
    return " UNION ALL ".join(parts)


@query(_corrections_sql())
def bulk_corrections(spark, sf_dir):
    tables, rules = {}, {}
    for name, (key, changes, where) in RULES.items():
        loaded = logs.table(spark, sf_dir, name).withColumn(
            ID, F.col(key).cast("string") if key else logs.line_id())
        tables[name] = VersionedTable(dml.put(loaded, 1, LOADED_AT, distinct_ids=True), open_ended=True)
        rules[name] = reports.Correction(
            {c: F.expr(e) for c, e in changes.items()}, F.expr(where) if where else None)
    corrected = reports.bulk_corrections(tables, rules, 2, CORRECTED_AT)
    shown = []
    for name, table in corrected.items():
        number, text = SHOWN[name]
        # Nothing is dated after the correction, so its puts stay open-ended.
        shown.append(replace(table, open_ended=True).all_versions().select(
            F.lit(name).alias("table_name"), ID, F.expr(number).alias("number"),
            F.expr(text).alias("text"), VALID_FROM, VALID_TO))
    result = shown[0]
    for part in shown[1:]:
        result = result.unionByName(part)
    return result

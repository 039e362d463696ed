"""Aggregations."""

from pyspark.sql import functions as F

from tidemark.operators import relational, travel
from tidemark.operators.reports import millionths, money
from tidemark.queries import logs
from tidemark.queries.registry import query


@query("SELECT count(*) AS n FROM lineitem")
def count_star(spark, sf_dir):
    return logs.table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


@query("""SELECT c_nationkey, count(*) AS all_rows, count(o_orderkey) AS with_order FROM customer
  LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) ON c_custkey = o_custkey
  GROUP BY c_nationkey""")
def count_column(spark, sf_dir):
    customer = logs.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # Counted per customer first: a customer with very many orders joins as one row.
    dear = logs.table(spark, sf_dir, "orders").where("o_totalprice > 400000").groupBy(
        "o_custkey").agg(F.count("*").alias("rows"), F.count("o_orderkey").alias("orders"))
    return customer.join(dear, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy(
        "c_nationkey").agg(
        F.sum(F.coalesce("rows", F.lit(1))).alias("all_rows"),
        F.sum(F.coalesce("orders", F.lit(0))).alias("with_order"))


@query("""SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders,
  count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag""")
def count_distinct(spark, sf_dir):
    return logs.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"),
        F.count_distinct("l_suppkey").alias("suppliers"))


@query("""SELECT l_returnflag, CAST(round(sum(CAST(l_extendedprice * (1 - l_discount)
  AS DECIMAL(24,6))), 2) AS DOUBLE) AS revenue FROM lineitem GROUP BY l_returnflag""")
def sum_expr(spark, sf_dir):
    revenue = millionths(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return logs.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        money(F.sum(revenue)).alias("revenue"))


@query("""SELECT l_linestatus, CAST(CAST(avg(CAST(l_extendedprice AS DECIMAL(18,2)))
    AS DECIMAL(10,2)) AS DOUBLE) AS avg_price,
  CAST(CAST(avg(CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(4,2)) AS DOUBLE) AS avg_discount
  FROM lineitem GROUP BY l_linestatus""")
def avg_decimal(spark, sf_dir):
    def mean(column, target):
        return F.avg(F.col(column).cast("decimal(18,2)")).cast(target).cast("double")

    return logs.table(spark, sf_dir, "lineitem").groupBy("l_linestatus").agg(
        mean("l_extendedprice", "decimal(10,2)").alias("avg_price"),
        mean("l_discount", "decimal(4,2)").alias("avg_discount"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT)
  AS quantity, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_by_multi(spark, sf_dir):
    return logs.table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("lines"), F.sum("l_quantity").cast("bigint").alias("quantity"),
        F.max("l_shipdate").alias("last_ship"))


@query("""SELECT coalesce(device, 'unknown') AS device, n FROM (SELECT device, count(*) AS n
  FROM (SELECT CASE event_type WHEN 'click' THEN 'mobile' WHEN 'view' THEN 'unknown'
    WHEN 'signup' THEN 'desktop' END AS device FROM events) GROUP BY device)""")
def group_by_coalesced_label(spark, sf_dir):
    device = F.expr("""CASE event_type WHEN 'click' THEN 'mobile' WHEN 'view' THEN 'unknown'
        WHEN 'signup' THEN 'desktop' END""")
    events = logs.table(spark, sf_dir, "events").select(device.alias("device"))
    return relational.count_by_label(events, "device", "unknown", "n")


_COUNTED = ("customer", "orders", "lineitem", "supplier", "part", "events", "documents")


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED))
def table_counts(spark, sf_dir):
    return relational.table_counts({t: logs.table(spark, sf_dir, t) for t in _COUNTED})


@query("""SELECT user_id AS _id, min(ts) AS first_valid_from FROM events
  WHERE event_type <> 'error' GROUP BY user_id""")
def first_seen(spark, sf_dir):
    return travel.first_seen(logs.events_log(spark, sf_dir).columns().all_versions())

"""Loading, storing and streaming: the given tables written out in each format and read back.

What is written goes to a folder of its own below the session's shared checkpoint folder.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.columns import ID, OP, PUT, SEQ, VALID_FROM, VALID_TO
from tidemark.functions import names, nested, temporal
from tidemark.operators import dml, relational
from tidemark.operators.travel import VersionedTable
from tidemark.queries import changes, logs
from tidemark.queries.logs import as_of_cte
from tidemark.queries.registry import query
from tidemark.session import checkpoint_dir
from tidemark.sources import catalog, cdc, records, transit
from tidemark.sources.store import LogStore
from tidemark.streaming import cdc_stream

NOW = changes.NOW
#: Documents of one JSON array.
ARRAY = 1000


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/loading-{uuid.uuid4().hex}"


def _written_arrays(spark: SparkSession, rows: DataFrame, number: str, text: str) -> str:
    """JSON array files of up to ``ARRAY`` documents each, in the order of ``number``."""
    part = F.floor(F.col(number) / ARRAY).cast("long").alias("part")
    listed = F.array_sort(F.collect_list(F.struct(F.col(number).alias("at"), F.col(text).alias("doc"))))
    arrays = rows.groupBy(part).agg(F.concat(
        F.lit("["), F.array_join(F.transform(listed, lambda x: x["doc"]), ","), F.lit("]")).alias("value"))
    arrays.write.partitionBy("part").text(folder := _folder(spark))
    return folder


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_array_files(spark, sf_dir):
    customers = logs.table(spark, sf_dir, "customer").select("c_custkey", F.to_json(F.struct("c_custkey", "c_name", "c_acctbal")).alias("doc"))
    path = _written_arrays(spark, customers, "c_custkey", "doc")
    return records.read_json_array(spark, path, "c_custkey bigint, c_name string, c_acctbal double").drop("part")


@query("SELECT event_id % 1000 AS place, event_type = 'error' AS deleted, CAST(user_id AS VARCHAR) AS record_id, event_type AS kind, value AS amount FROM events")
def cdc_array_files(spark, sf_dir):
    path = _written_arrays(spark, changes.envelope_events(spark, sf_dir), "_position", "event")
    found = cdc.accepted(cdc.normalise(cdc.read_array_file(spark, path), NOW))
    return found.select(
        F.col(SEQ).alias("place"), "deleted", "record_id", nested.path("data", "kind").alias("kind"),
        nested.path("data", "amount", as_type="double").alias("amount"))


_ORDER_LINES = """SELECT o_orderkey AS _id, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS since,
  '~' || o_orderpriority AS mark FROM orders"""


@query(_ORDER_LINES)
def transit_lines(spark, sf_dir):
    """Orders as transit-JSON lines, marks in text and instants included, and back."""
    orders = logs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(ID), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("since"), F.concat(F.lit("~"), "o_orderpriority").alias("mark"))
    transit.to_lines(orders).write.text(path := _folder(spark))
    return transit.read_lines(spark, path, "_id bigint, status string, price double, since timestamp_ntz, mark string")


@query("""SELECT o_orderkey AS _id, '["^ ","~:_id",' || o_orderkey || ',"~:status","' || o_orderstatus || '","~:tags",["~~x"]]' AS value FROM orders""")
def transit_export(spark, sf_dir):
    orders = logs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(ID), F.col("o_orderstatus").alias("status"), F.array(F.lit("~x")).alias("tags"))
    return transit.to_lines(orders).select(F.regexp_extract("value", r'"~:_id",(\d+)', 1).cast("bigint").alias(ID), "value")


@query("SELECT r_regionkey AS _id, r_name AS name, CASE WHEN r_regionkey > 1 THEN r_regionkey * 2 END AS weight FROM region")
def insert_literal_records(spark, sf_dir):
    """Records written down row by row, of which some lack a key."""
    rows = [{"_id": r[0], "name": r[1], **({"weight": r[0] * 2} if r[0] > 1 else {})}
            for r in logs.table(spark, sf_dir, "region").select("r_regionkey", "r_name").collect()]
    return VersionedTable(dml.put(records.from_literals(spark, rows, "_id bigint, name string, weight bigint"), 1, NOW), open_ended=True).current(NOW)


@query("""SELECT o_orderkey AS _id, o_orderstatus, o_orderdate AS _valid_from, o_orderdate + INTERVAL 30 DAY AS _valid_to FROM orders""")
def insert_columns(spark, sf_dir):
    """A column list that names the period of each record."""
    rows = logs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(ID), "o_orderstatus", F.col("o_orderdate").alias(VALID_FROM), (F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")).alias(VALID_TO))
    return VersionedTable(dml.put(rows, 1, NOW, distinct_ids=True)).all_versions().select(ID, "o_orderstatus", VALID_FROM, VALID_TO)


@query("""SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
  UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def store_tables_in_one_transaction(spark, sf_dir):
    store = LogStore(spark, _folder(spark))
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "supplier": "s_suppkey"}
    store.transact(NOW, {name: dml.put(logs.table(spark, sf_dir, name).withColumn(ID, F.col(key)), 0, NOW, distinct_ids=True) for name, key in keys.items()})
    return relational.table_counts({name: store.table(name).current(NOW) for name in keys})


@query("""SELECT c_custkey AS _id, c_name AS name, CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS segment FROM customer""")
def schema_change_between_transactions(spark, sf_dir):
    """A later transaction brings a column that the first did not know."""
    store, customers = LogStore(spark, _folder(spark)), logs.table(spark, sf_dir, "customer").withColumn(ID, F.col("c_custkey"))
    first = customers.select(ID, F.col("c_name").alias("name"))
    second = customers.where("c_acctbal < 0").select(ID, F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    store.transact("2024-01-01 00:00:00", {"customer": dml.put(first, 0, "2024-01-01 00:00:00", distinct_ids=True)})
    store.transact("2024-01-02 00:00:00", {"customer": dml.put(second, 1, "2024-01-02 00:00:00", distinct_ids=True)})
    return store.table("customer").current(NOW)


@query("""SELECT n_name AS nation, count(*) AS orders, count(DISTINCT c_custkey) AS customers FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def tables_of_two_databases(spark, sf_dir):
    """One query over tables that are kept in two databases."""
    mark = uuid.uuid4().hex[:12]
    sales, people = f"sales_{mark}", f"people_{mark}"
    catalog.use_databases(spark, {f"{sales}.orders": logs.table(spark, sf_dir, "orders"), f"{people}.customer": logs.table(spark, sf_dir, "customer"),
                                  f"{people}.nation": logs.table(spark, sf_dir, "nation")})
    return spark.sql(f"""SELECT n_name AS nation, count(*) AS orders, count(DISTINCT c_custkey) AS customers FROM {sales}.orders
        JOIN {people}.customer ON o_custkey = c_custkey JOIN {people}.nation ON c_nationkey = n_nationkey GROUP BY n_name""")


@query("""SELECT p_partkey AS _id, p_name AS "part$name", p_retailprice AS "part$retail_price", p_size AS "part$box$size" FROM part""")
def namespaced_columns(spark, sf_dir):
    part = logs.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(":part/id"), F.col("p_name").alias(":part/name"), F.col("p_retailprice").alias(":part/retail-price"), F.col("p_size").alias("part.box/Size"))
    return names.normalise_columns(part, "part/id")


@query("SELECT o_orderkey, CAST(year(current_date) - year(o_orderdate) AS INTEGER) AS years FROM orders")
def years_until_today(spark, sf_dir):
    return logs.table(spark, sf_dir, "orders").select("o_orderkey", temporal.age(F.col("o_orderdate")).alias("years"))


@query("""SELECT c_custkey, c_name AS name, [c_nationkey, c_custkey][2] AS second, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
  c_mktsegment AS segment FROM customer""")
def nested_round_trip(spark, sf_dir):
    """Structs, arrays and maps through Parquet and back."""
    row = logs.table(spark, sf_dir, "customer").select("c_custkey", F.struct(
        F.col("c_name").alias("name"), F.array(F.col("c_nationkey").cast("bigint"), F.col("c_custkey").cast("bigint")).alias("keys"),
        F.create_map(F.lit("balance"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")), F.lit("other"), F.lit(None)).alias("amounts"),
        F.array(F.struct(F.col("c_mktsegment").alias("segment"))).alias("parts")).alias("doc"))
    row.write.parquet(path := _folder(spark))
    return spark.read.parquet(path).select(
        "c_custkey", "doc.name", F.col("doc.keys")[1].alias("second"), F.col("doc.amounts")["balance"].alias("balance"),
        F.col("doc.parts")[0]["segment"].alias("segment"))


@query("SELECT event_id AS seq, CASE WHEN value IS NULL THEN 'kind' ELSE 'amount,kind' END AS keys FROM events WHERE event_type <> 'error'")
def cdc_record_keys(spark, sf_dir):
    """Keys of the records: neither the id nor what begins with two underscores."""
    log = cdc.to_log(cdc.normalise(changes.envelope_events(spark, sf_dir), NOW), 0, NOW)
    return log.where(F.col(OP) == PUT).select(F.col(SEQ).alias("seq"), F.array_join(F.sort_array(records.provided_keys("doc")), ",").alias("keys"))


@query(f"""SELECT event_id AS seq, CASE WHEN event_type IN ('click', 'view') THEN date_trunc('millisecond', ts) ELSE TIMESTAMP '{NOW}' END AS valid_from FROM events""")
def cdc_event_times(spark, sf_dir):
    """Times as numbers and as text of numbers count; other text and none fall back to now."""
    events = logs.table(spark, sf_dir, "events")
    body = "'id', user_id, '__op', 'c', '__table', 'shop.states'"
    text = F.expr(f"""CASE event_type WHEN 'click' THEN to_json(named_struct({body}, '__source_ts_ms', {changes._MILLIS}))
      WHEN 'view' THEN to_json(named_struct({body}, '__source_ts_ms', CAST({changes._MILLIS} AS STRING)))
      WHEN 'purchase' THEN to_json(named_struct({body}, '__source_ts_ms', 'soon')) ELSE to_json(named_struct({body})) END""")
    found = cdc.accepted(cdc.normalise(events.select(F.col("event_id").alias("_position"), text.alias("event")), NOW))
    return found.select(F.col(SEQ).alias("seq"), "valid_from")


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """Change events as JSON lines, those of a user in one file and in their order."""
    events = changes.envelope_events(spark, sf_dir).join(logs.table(spark, sf_dir, "events").select(F.col("event_id").alias("_position"), "user_id"), "_position")
    events.repartition("user_id").sortWithinPartitions("_position").select("event").write.text(path := _folder(spark))
    return path


_CURRENT = f"WITH {changes._CDC_LOG}, {as_of_cte('log', 'state', NOW)} SELECT _id, kind, amount FROM state"


@query(_CURRENT)
def cdc_apply_files(spark, sf_dir):
    """Change events of many files, in the order of each file."""
    log = cdc.to_log(cdc.normalise(cdc.read_lines(spark, _event_files(spark, sf_dir)), NOW), 0, NOW)
    return changes._promoted(VersionedTable(log.drop("table"), open_ended=True).current(NOW))


def _streamed(spark: SparkSession, sf_dir: str, monitor: tuple[str, ...] = ()) -> LogStore:
    """The events streamed into a store; the stream is started again, which must change nothing."""
    source, store = _event_files(spark, sf_dir), LogStore(spark, _folder(spark))
    for _ in range(2):
        cdc_stream.apply(cdc_stream.from_files(spark, source), store, f"{store.root}/progress", monitor=monitor).awaitTermination()
    return store


@query(_CURRENT)
def cdc_stream_state(spark, sf_dir):
    return changes._promoted(_streamed(spark, sf_dir).table("userstates", open_ended=True).current(NOW))


@query(f"WITH {changes._CDC_LOG}, {as_of_cte('log', 'state', NOW)} SELECT 'userstates' AS table_name, count(*) AS current_count, count(*) AS change FROM state")
def cdc_stream_monitor(spark, sf_dir):
    """Counts of the current records after each batch."""
    return cdc_stream.monitor_log(_streamed(spark, sf_dir, ("userstates",))).select("table_name", "current_count", "change")

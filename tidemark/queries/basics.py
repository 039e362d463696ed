"""Scans, projections, filters, sorting and set operations."""

from pyspark.sql import functions as F

from tidemark.columns import ID, VALID_FROM, VALID_TO
from tidemark.functions import infer
from tidemark.operators import relational, travel
from tidemark.queries import logs
from tidemark.queries.logs import EVENTS_SQL, as_of_sql, versions_sql
from tidemark.queries.registry import query
from tidemark.sources import records

NOW = "2024-02-01 00:00:00"

LABELS = [
    {"event_type": "click", "stage": "browse", "note": "unlisted keys are dropped"},
    {"event_type": "view", "stage": "browse"},
    {"event_type": "signup", "stage": "join"},
    {"event_type": "purchase", "stage": "buy"},
]
LABELS_SQL = "(VALUES ('click','browse'),('view','browse'),('signup','join'),('purchase','buy'))"


@query(f"""SELECT stage, count(*) AS n FROM events
  JOIN {LABELS_SQL} AS l(event_type, stage) USING (event_type) GROUP BY stage""")
def rel_inline(spark, sf_dir):
    stages = relational.rel(spark, LABELS, "event_type string, stage string")
    events = logs.table(spark, sf_dir, "events")
    return events.join(F.broadcast(stages), "event_type").groupBy("stage").agg(
        F.count("*").alias("n"))


@query("""SELECT c_custkey, c_name, tier FROM customer
  JOIN (VALUES ('BUILDING', 'gold'), ('MACHINERY', 'silver')) AS t(segment, tier)
    ON c_mktsegment = segment""")
def rel_param_join(spark, sf_dir, tiers=(("BUILDING", "gold"), ("MACHINERY", "silver"))):
    rows = [{"c_mktsegment": s, "tier": t} for s, t in tiers]
    given = relational.rel(spark, rows, "c_mktsegment string, tier string")
    customer = logs.table(spark, sf_dir, "customer")
    return relational.unify(
        customer.select("c_custkey", "c_name", "c_mktsegment"), F.broadcast(given)
    ).select("c_custkey", "c_name", "tier")


@query(as_of_sql(EVENTS_SQL, NOW, "SELECT _id, event_type FROM state"))
def scan_current(spark, sf_dir):
    return logs.events_log(spark, sf_dir).columns("event_type").current(NOW)


@query("""SELECT event_id AS _id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  ts AS _valid_from FROM events""")
def json_records_ingest(spark, sf_dir):
    from tidemark.operators import dml

    events = logs.table(spark, sf_dir, "events")
    text = events.select(
        F.concat(F.lit('{"_id":'), "event_id", F.lit(',"props":'), "props", F.lit("}")).alias("json"),
        F.col("ts").alias(VALID_FROM))
    docs = records.from_json_text(text, "json", "bigint")
    log = dml.put(docs, 1, NOW, distinct_ids=True)
    return log.select(ID, F.try_variant_get("doc", "$.props.k", "bigint").alias("k"), VALID_FROM)


_BROKEN = """CASE WHEN event_id % 7 = 0 THEN '{"_id":' || event_id || ',' WHEN event_id % 11 = 0 THEN '{"k":1}'
  WHEN event_id % 13 = 0 THEN '' ELSE '{"_id":' || event_id || '}' END"""


@query(f"""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'not json' WHEN event_id % 11 = 0 THEN 'no id'
  ELSE 'empty value' END AS reject_reason, {_BROKEN} AS json
  FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0""")
def json_rejects(spark, sf_dir):
    texts = logs.table(spark, sf_dir, "events").select("event_id", F.expr(_BROKEN).alias("json"))
    return records.rejected_json(texts, "json", "bigint")


_TEXT_SQL = """SELECT 'user_id' AS name, CAST(user_id AS VARCHAR) AS v FROM events
  UNION ALL SELECT 'event_type', event_type FROM events
  UNION ALL SELECT 'ts', strftime(ts, '%Y-%m-%d %H:%M:%S') FROM events
  UNION ALL SELECT 'day', strftime(ts, '%Y-%m-%d') FROM events
  UNION ALL SELECT 'buyer', CASE WHEN event_type = 'purchase' THEN 't' ELSE 'f' END FROM events
  UNION ALL SELECT 'amount', CASE WHEN event_type = 'purchase'
    THEN '1.5' WHEN event_type = 'view' THEN '2' ELSE '\\N' END FROM events"""


@query(f"""WITH texts AS ({_TEXT_SQL}) SELECT name, kind, count(*) AS n FROM (
  SELECT name, CASE WHEN v IS NULL OR v = '\\N' THEN 'null'
    WHEN regexp_full_match(v, '-?[0-9]+') THEN 'long'
    WHEN regexp_full_match(v, '-?[0-9]+\\.[0-9]+') THEN 'double'
    WHEN lower(v) IN ('t', 'true', 'f', 'false') THEN 'boolean'
    WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'date'
    WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9:]{{8}}') THEN 'timestamp'
    ELSE 'string' END AS kind FROM texts) GROUP BY name, kind""")
def typed_inference(spark, sf_dir):
    events = logs.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    texts = {
        "user_id": F.col("user_id").cast("string"),
        "event_type": kind,
        "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "day": F.date_format("ts", "yyyy-MM-dd"),
        "buyer": F.when(kind == "purchase", "t").otherwise("f"),
        "amount": F.when(kind == "purchase", "1.5").when(kind == "view", "2").otherwise(infer.NULL_TEXT),
    }
    entries = F.array(*[F.struct(F.lit(n).alias("name"), c.alias("v")) for n, c in texts.items()])
    return events.select(F.explode(entries).alias("e")).groupBy(
        F.col("e.name").alias("name"), infer.kind_of(F.col("e.v")).alias("kind")
    ).agg(F.count("*").alias("n"))


@query(f"""SELECT _tx, max(_valid_from) AS system_time, count(*) AS writes
  FROM ({logs.ORDERS_SQL}) GROUP BY _tx""")
def tx_log(spark, sf_dir):
    return travel.transaction_log(logs.orders_log(spark, sf_dir).log)


@query("""SELECT 'orders' AS table_name, max(o_orderkey) + 1 AS expected, count(*) AS found,
    max(o_orderkey) + 1 = count(*) AS complete FROM orders
  UNION ALL SELECT 'customer', max(c_custkey) + 1, count(*), max(c_custkey) + 1 = count(*) FROM customer
  UNION ALL SELECT 'events', max(event_id) + 1, count(*), max(event_id) + 1 = count(*) FROM events""")
def load_count_check(spark, sf_dir):
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "events": "event_id"}
    parts = [
        logs.table(spark, sf_dir, name).agg(
            (F.max(key) + 1).alias("expected"), F.count("*").alias("found")
        ).select(F.lit(name).alias("table_name"), "expected", "found",
                 (F.col("expected") == F.col("found")).alias("complete"))
        for name, key in keys.items()
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def project(spark, sf_dir):
    return logs.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


@query(as_of_sql(EVENTS_SQL, NOW, "SELECT _id, event_type, value, props FROM state"))
def select_star_current(spark, sf_dir):
    return travel.hide_temporal(logs.events_log(spark, sf_dir).current(NOW))


@query(versions_sql(EVENTS_SQL, """SELECT _id, event_type, _valid_from AS vt_from,
  _valid_to AS vt_to, _valid_from AS st_from FROM versions"""))
def temporal_columns(spark, sf_dir):
    found = travel.with_temporal_columns(
        logs.events_log(spark, sf_dir).columns("event_type").all_versions())
    return found.select(
        ID, "event_type", F.col("_valid_time.from").alias("vt_from"),
        F.col("_valid_time.to").alias("vt_to"), F.col("_system_time.from").alias("st_from"))


@query("""SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation""")
def star_struct(spark, sf_dir):
    nested = logs.table(spark, sf_dir, "nation").select(F.struct("*").alias("record"))
    return nested.select(
        F.col("record.n_nationkey").alias("key"), F.col("record.n_name").alias("name"),
        F.col("record.n_regionkey").alias("region"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1 - l_discount) AS net,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem""")
def with_column(spark, sf_dir):
    lines = logs.table(spark, sf_dir, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return lines.withColumns({"net": net, "gross": net * (1 + F.col("l_tax"))}).select(
        "l_orderkey", "l_linenumber", "l_partkey", "net", "gross")


@query("SELECT s_suppkey AS supplier, s_name AS name, s_nationkey AS nation FROM supplier")
def rename_binding(spark, sf_dir):
    return relational.bind(
        logs.table(spark, sf_dir, "supplier"),
        supplier="s_suppkey", name="s_name", nation="s_nationkey")


@query("SELECT c_custkey AS c, c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING'")
def literal_binding_filter(spark, sf_dir):
    return relational.bind(
        logs.table(spark, sf_dir, "customer"),
        c="c_custkey", name="c_name", c_mktsegment=F.lit("BUILDING"))


@query("""SELECT 'lt' AS test, count(*) AS n FROM orders WHERE o_totalprice < 50000
  UNION ALL SELECT 'le', count(*) FROM orders WHERE o_totalprice <= 50000
  UNION ALL SELECT 'gt', count(*) FROM orders WHERE o_totalprice > 50000
  UNION ALL SELECT 'ge', count(*) FROM orders WHERE o_totalprice >= 50000
  UNION ALL SELECT 'eq', count(*) FROM orders WHERE o_orderstatus = 'O'""")
def where_compare(spark, sf_dir):
    price = F.col("o_totalprice")
    tests = {
        "lt": price < 50000, "le": price <= 50000, "gt": price > 50000, "ge": price >= 50000,
        "eq": F.col("o_orderstatus") == "O",
    }
    counts = logs.table(spark, sf_dir, "orders").agg(
        *[F.count_if(test).alias(name) for name, test in tests.items()])
    return counts.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(n) for n in tests]), F.array(*tests))).alias("test", "n"))


@query("""SELECT o_orderkey, o_totalprice FROM orders
  WHERE o_orderstatus = 'F' AND o_totalprice >= 100000 AND o_orderdate < TIMESTAMP '1998-01-01'""")
def where_and(spark, sf_dir):
    return logs.table(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 100000)
        & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    ).select("o_orderkey", "o_totalprice")


@query("SELECT doc_id, lang FROM documents WHERE text LIKE '%icense%'")
def like_filter(spark, sf_dir):
    documents = logs.table(spark, sf_dir, "documents")
    return documents.where(F.col("text").like("%icense%")).select("doc_id", "lang")


@query(versions_sql(EVENTS_SQL, """SELECT event_type, count(*) AS versions,
  CAST(sum(CASE WHEN _valid_to IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS open_ended,
  CAST(sum(CASE WHEN _valid_to IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS closed
  FROM versions GROUP BY event_type"""))
def null_filters(spark, sf_dir):
    found = logs.events_log(spark, sf_dir).columns("event_type").all_versions()
    return found.groupBy("event_type").agg(
        F.count("*").alias("versions"),
        F.count_if(F.col(VALID_TO).isNull()).alias("open_ended"),
        F.count_if(F.col(VALID_TO).isNotNull()).alias("closed"))


@query("""SELECT o_orderkey, o_custkey FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def in_subquery(spark, sf_dir):
    indebted = logs.table(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        F.col("c_custkey").alias("o_custkey"))
    orders = logs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(indebted, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("""SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'large'
  WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'small' END AS size FROM orders""")
def case_searched(spark, sf_dir):
    price = F.col("o_totalprice")
    size = F.when(price >= 300000, "large").when(price >= 100000, "medium").otherwise("small")
    return logs.table(spark, sf_dir, "orders").select("o_orderkey", size.alias("size"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'P' WHEN 'P' THEN 'F'
  ELSE o_orderstatus END AS next_status FROM orders""")
def case_simple(spark, sf_dir):
    status = F.expr("CASE o_orderstatus WHEN 'O' THEN 'P' WHEN 'P' THEN 'F' ELSE o_orderstatus END")
    return logs.table(spark, sf_dir, "orders").select("o_orderkey", status.alias("next_status"))


@query("SELECT p_partkey, p_name FROM part WHERE p_size > 25 AND p_brand = 'Brand#2'")
def param_query(spark, sf_dir, size=25, brand="Brand#2"):
    part = logs.table(spark, sf_dir, "part")
    return spark.sql(
        "SELECT p_partkey, p_name FROM {part} WHERE p_size > :size AND p_brand = :brand",
        args={"size": size, "brand": brand}, part=part)


@query("""SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'
  AND o_orderdate < TIMESTAMP '1996-01-01' + INTERVAL 1 YEAR""")
def date_range_filter(spark, sf_dir, start="1996-01-01"):
    first = F.lit(start).cast("timestamp_ntz")
    day = F.col("o_orderdate")
    return logs.table(spark, sf_dir, "orders").where(
        (day >= first) & (day < first + F.expr("INTERVAL 1 YEAR"))
    ).select("o_orderkey", "o_orderdate")


@query("""SELECT c_mktsegment, c_custkey, c_acctbal FROM customer
  ORDER BY c_mktsegment NULLS LAST, c_acctbal DESC NULLS LAST, c_custkey""")
def order_by(spark, sf_dir):
    return logs.table(spark, sf_dir, "customer").select(
        "c_mktsegment", "c_custkey", "c_acctbal"
    ).orderBy(F.asc_nulls_last("c_mktsegment"), F.desc_nulls_last("c_acctbal"), "c_custkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def order_limit(spark, sf_dir, n=20):
    return logs.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey").limit(n)


@query(versions_sql(EVENTS_SQL, """SELECT _id, event_type, _valid_from FROM versions
  ORDER BY _valid_from DESC, _id LIMIT 3"""))
def latest_versions_topk(spark, sf_dir, k=3):
    found = logs.events_log(spark, sf_dir).columns("event_type").all_versions()
    return found.orderBy(F.desc(VALID_FROM), ID).select(ID, "event_type", VALID_FROM).limit(k)


@query("""SELECT 'customer' AS kind, c_nationkey AS nationkey, c_acctbal AS balance FROM customer
  UNION ALL SELECT 'supplier', s_nationkey, s_acctbal FROM supplier""")
def union_all(spark, sf_dir):
    customer = logs.table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("balance"))
    supplier = logs.table(spark, sf_dir, "supplier").select(
        F.lit("supplier"), "s_nationkey", "s_acctbal")
    return customer.union(supplier)


@query("""SELECT c_custkey AS _id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance
  FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def jagged_union(spark, sf_dir):
    customer = logs.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(ID), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"))
    supplier = logs.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias(ID), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"))
    return relational.jagged_union(customer, supplier)

"""Scalar and nested functions over whole tables."""

from pyspark.sql import functions as F

from tidemark.functions import nested, temporal
from tidemark.queries import logs
from tidemark.queries.registry import query


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
  (l_quantity + 1) * 2 - l_linenumber AS score, l_extendedprice * (1 - l_discount) AS net
  FROM lineitem""")
def arithmetic(spark, sf_dir):
    return logs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        ((F.col("l_quantity") + 1) * 2 - F.col("l_linenumber")).alias("score"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))


@query("SELECT p_partkey, upper(p_name) AS name FROM part")
def upper_fn(spark, sf_dir):
    return logs.table(spark, sf_dir, "part").select("p_partkey", F.upper("p_name").alias("name"))


@query("""SELECT o_orderkey, o_orderstatus || ': ' || o_orderpriority AS label,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END || ' - updated' AS note FROM orders""")
def string_concat(spark, sf_dir):
    note = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    return logs.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat("o_orderstatus", F.lit(": "), "o_orderpriority").alias("label"),
        F.concat(note, F.lit(" - updated")).alias("note"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
  least(l_discount + CAST(0.03 AS DOUBLE), CAST(0.10 AS DOUBLE)) AS capped FROM lineitem""")
def least_cap(spark, sf_dir):
    return logs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.least(F.col("l_discount") + 0.03, F.lit(0.10)).alias("capped"))


@query("""SELECT d.doc_id, coalesce(quality, -1) AS quality FROM documents d
  LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def coalesce_fn(spark, sf_dir):
    documents = logs.table(spark, sf_dir, "documents").select("doc_id")
    labels = logs.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id", "left").select(
        "doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"))


@query("""SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(10,1)) AS DOUBLE) AS tenth,
  CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS DOUBLE) AS cents FROM customer""")
def cast_decimal(spark, sf_dir):
    cents = F.col("c_acctbal").cast("decimal(10,2)")
    tenth = F.col("c_acctbal").cast("decimal(10,1)")
    return logs.table(spark, sf_dir, "customer").select(
        "c_custkey", tenth.cast("double").alias("tenth"), cents.cast("double").alias("cents"))


@query("""SELECT o_orderkey, CAST(2002 - year(o_orderdate) AS INTEGER) AS age FROM orders""")
def year_diff(spark, sf_dir, as_of="2002-01-01"):
    return logs.table(spark, sf_dir, "orders").select(
        "o_orderkey", temporal.age(F.col("o_orderdate"), F.lit(as_of).cast("date")).alias("age"))


@query("""SELECT o_orderkey, CAST(DATE '1998-01-01' AS TIMESTAMP) AS day, TIMESTAMP '1998-01-01 06:30:00' AS moment,
  o_orderdate >= TIMESTAMP '1998-01-01 06:30:00' AS later FROM orders""")
def typed_literals(spark, sf_dir):
    moment = F.expr("timestamp_ntz'1998-01-01 06:30:00'")
    return logs.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("date'1998-01-01'").cast("timestamp_ntz").alias("day"), moment.alias("moment"),
        (F.col("o_orderdate") >= moment).alias("later"))


@query("""SELECT o_orderkey, o_orderdate + INTERVAL 7 DAY AS week_later,
  o_orderdate + INTERVAL 1 YEAR AS year_later FROM orders""")
def date_add_interval(spark, sf_dir):
    return logs.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("o_orderdate + INTERVAL 7 DAY").alias("week_later"),
        F.expr("o_orderdate + INTERVAL 1 YEAR").alias("year_later"))


@query("""SELECT event_id, date_trunc('millisecond', ts) AS moment FROM events""")
def epoch_ms_to_ts(spark, sf_dir):
    millis = F.unix_timestamp("ts") * 1000 + F.date_format("ts", "SSS").cast("bigint")
    return logs.table(spark, sf_dir, "events").select(
        "event_id", temporal.from_epoch_millis(millis).alias("moment"))


@query("""SELECT event_id, CAST(strftime(ts, '%Y-%m-%d %H:%M:00') AS TIMESTAMP) AS moment
  FROM events""")
def iso_text_to_ts(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z[UTC]'")
    parsed = temporal.parse_iso(F.col("iso"))
    return logs.table(spark, sf_dir, "events").select("event_id", text.alias("iso")).select(
        "event_id", F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), parsed.cast("timestamp_ntz")).alias("moment"))


@query("""SELECT event_id, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS seconds,
  CAST((hour(ts) * 3600 + minute(ts) * 60) AS BIGINT) * 1000000000 AS nanos FROM events""")
def duration_and_time_text(spark, sf_dir):
    events = logs.table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "'PT'H'H'm'M's'S'").alias("duration"),
        F.date_format("ts", "HH:mm").alias("time"))
    return events.select(
        "event_id",
        temporal.seconds_of(temporal.parse_duration(F.col("duration"))).cast("bigint").alias("seconds"),
        temporal.time_to_nanos(F.col("time")).alias("nanos"))


@query("""SELECT user_id, count(*) AS overlapping FROM events
  WHERE ts < TIMESTAMP '2024-01-12' AND ts + INTERVAL 2 DAY > TIMESTAMP '2024-01-10'
  GROUP BY user_id""")
def period_overlap(spark, sf_dir):
    spoken = temporal.period(F.col("ts"), F.expr("ts + INTERVAL 2 DAY"))
    asked = temporal.period(
        F.expr("timestamp_ntz'2024-01-10 00:00:00'"), F.expr("timestamp_ntz'2024-01-12 00:00:00'"))
    return logs.table(spark, sf_dir, "events").where(
        temporal.period_overlaps(spoken, asked)
    ).groupBy("user_id").agg(F.count("*").alias("overlapping"))


@query("""SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[2] AS DOUBLE) AS second,
  CAST(embedding[10000] AS DOUBLE) AS missing FROM embeddings""")
def array_nth(spark, sf_dir):
    return logs.table(spark, sf_dir, "embeddings").select(
        "vec_id", nested.nth("embedding", 0).cast("double").alias("first"),
        nested.element("embedding", 2).cast("double").alias("second"),
        nested.nth("embedding", 9999).cast("double").alias("missing"))


@query("""SELECT vec_id, count(*) AS n, CAST(max(x) AS DOUBLE) AS top FROM (
  SELECT vec_id, unnest(embedding) AS x FROM embeddings) GROUP BY vec_id""")
def unnest(spark, sf_dir):
    from tidemark.operators import relational

    rows = relational.unnest(logs.table(spark, sf_dir, "embeddings"), "embedding", "x")
    return rows.groupBy("vec_id").agg(
        F.count("*").alias("n"), F.max("x").cast("double").alias("top"))


@query("SELECT conv_id, turn, role, length(text) AS chars FROM conversations")
def struct_field(spark, sf_dir):
    message = F.struct("role", F.struct("text").alias("content"))
    turns = logs.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", message.alias("message"))
    return turns.select(
        "conv_id", "turn", F.col("message.role").alias("role"),
        F.length("message.content.text").cast("bigint").alias("chars"))


@query("""SELECT event_id, ts AS first_login, event_type AS second_tag,
  CAST(json_extract(props, '$.k') AS BIGINT) AS level FROM events""")
def nested_path(spark, sf_dir):
    document = F.parse_json(F.to_json(F.struct(F.struct(
        F.from_json("props", "k bigint").getField("k").alias("level"),
        F.struct(F.array(F.col("ts").cast("string")).alias("login_times"),
                 F.array(F.lit("any"), "event_type").alias("tags")).alias("settings"),
    ).alias("metadata"))))
    return logs.table(spark, sf_dir, "events").select("event_id", document.alias("doc")).select(
        "event_id",
        nested.path("doc", "metadata", "settings", "login_times", 0, as_type="timestamp_ntz")
        .alias("first_login"),
        nested.path("doc", "metadata", "settings", "tags", 1).alias("second_tag"),
        nested.path("doc", "metadata", "level", as_type="bigint").alias("level"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_path(spark, sf_dir):
    return logs.table(spark, sf_dir, "events").select(
        "event_id", nested.path(F.parse_json("props"), "k", as_type="bigint").alias("k"))


@query("""SELECT event_id, CASE WHEN event_type = 'purchase'
    THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  CASE WHEN event_type <> 'purchase' THEN event_id END AS number,
  CASE WHEN event_type = 'purchase' THEN 'object' ELSE 'scalar' END AS shape
  FROM events WHERE value > 50""")
def polymorphic_column(spark, sf_dir):
    info = F.when(F.col("event_type") == "purchase", F.col("props")).otherwise(
        F.col("event_id").cast("string"))
    mixed = logs.table(spark, sf_dir, "events").select(
        "event_id", "value", F.parse_json(info).alias("info"))
    shape = F.when(nested.kind("info").startswith("OBJECT"), "object").otherwise("scalar")
    return mixed.where("value > 50").select(
        "event_id", nested.path("info", "k", as_type="bigint").alias("k"),
        nested.scalar_key("info").alias("number"), shape.alias("shape"))


@query("""SELECT event_id, sha256(concat_ws('|', user_id, event_id, event_type)) AS id FROM events""")
def surrogate_id(spark, sf_dir):
    return logs.table(spark, sf_dir, "events").select(
        "event_id", F.sha2(F.concat_ws("|", "user_id", "event_id", "event_type"), 256).alias("id"))

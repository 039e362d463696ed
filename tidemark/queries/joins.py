"""Joins, unification and nesting."""

from pyspark.sql import functions as F

from tidemark.columns import ID
from tidemark.operators import relational, reports, theta, travel
from tidemark.operators.relational import bind, unify
from tidemark.queries import logs
from tidemark.queries.registry import query


@query("""SELECT o_orderkey, c_name, o_totalprice FROM orders
  JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O'""")
def inner_join(spark, sf_dir):
    orders = logs.table(spark, sf_dir, "orders").where("o_orderstatus = 'O'")
    customer = logs.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "o_totalprice")


@query("""SELECT n_name, CAST(round(sum(CAST(l_extendedprice * (1 - l_discount)
    AS DECIMAL(24,6))), 2) AS DOUBLE) AS revenue
  FROM customer, orders, lineitem, supplier, nation, region
  WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND l_suppkey = s_suppkey
    AND c_nationkey = s_nationkey AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
    AND r_name = 'ASIA' AND o_orderdate >= TIMESTAMP '1996-01-01'
    AND o_orderdate < TIMESTAMP '1996-01-01' + INTERVAL 1 YEAR
  GROUP BY n_name ORDER BY revenue DESC""")
def tpch_q5_local_supplier(spark, sf_dir, region="ASIA", start="1996-01-01"):
    names = ("customer", "orders", "lineitem", "supplier", "nation", "region")
    return reports.local_supplier_volume(
        *[logs.table(spark, sf_dir, n) for n in names], region, start)


@query("""SELECT s_nationkey AS nation, count(*) AS lines FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey GROUP BY s_nationkey""")
def composite_key_join(spark, sf_dir):
    lines = logs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = logs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = logs.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = logs.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    bought = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return (
        lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, (F.col("l_suppkey") == F.col("s_suppkey"))
              & (F.col("c_nationkey") == F.col("s_nationkey")))
        .groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("lines"))
    )


@query("""SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer
  LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 200000) ON c_custkey = o_custkey""")
def left_join(spark, sf_dir):
    customer = logs.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    dear = logs.table(spark, sf_dir, "orders").where("o_totalprice > 200000").select(
        "o_custkey", "o_orderkey", "o_totalprice")
    return relational.left_outer(customer, dear, "c_custkey", "o_custkey").drop("o_custkey")


@query("""SELECT c_mktsegment, count(o_orderkey) AS orders,
    CAST(coalesce(sum(lines), 0) AS BIGINT) AS lines
  FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON c_custkey = o_custkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY l_orderkey)
    ON o_orderkey = l_orderkey GROUP BY c_mktsegment""")
def left_join_chain(spark, sf_dir):
    lines = logs.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("lines"))
    finished = logs.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        "o_orderkey", "o_custkey")
    per_customer = finished.join(
        lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    ).groupBy("o_custkey").agg(F.count("*").alias("orders"), F.sum("lines").alias("lines"))
    customer = logs.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return customer.join(
        per_customer, F.col("c_custkey") == F.col("o_custkey"), "left"
    ).groupBy("c_mktsegment").agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"))


@query("""SELECT c_name AS customer, n_name AS nation, r_name AS region FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def unify_two_way(spark, sf_dir):
    # Stated in an order that shares nothing at first; unify finds the links.
    return unify(
        bind(logs.table(spark, sf_dir, "customer"), customer="c_name", n="c_nationkey"),
        bind(logs.table(spark, sf_dir, "region"), region="r_name", r="r_regionkey"),
        bind(logs.table(spark, sf_dir, "nation"), nation="n_name", n="n_nationkey", r="n_regionkey"),
    ).select("customer", "nation", "region")


@query("""SELECT n1.n_name AS buyer, n2.n_name AS seller, count(*) AS lines FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation n1 ON c_nationkey = n1.n_nationkey
  JOIN nation n2 ON s_nationkey = n2.n_nationkey AND n1.n_regionkey = n2.n_regionkey
  GROUP BY buyer, seller""")
def unify_self_join(spark, sf_dir):
    nation = logs.table(spark, sf_dir, "nation")
    return unify(
        bind(logs.table(spark, sf_dir, "lineitem"), o="l_orderkey", s="l_suppkey"),
        bind(logs.table(spark, sf_dir, "supplier"), s="s_suppkey", sn="s_nationkey"),
        bind(logs.table(spark, sf_dir, "orders"), o="o_orderkey", c="o_custkey"),
        bind(logs.table(spark, sf_dir, "customer"), c="c_custkey", cn="c_nationkey"),
        bind(nation, cn="n_nationkey", buyer="n_name", r="n_regionkey"),
        bind(nation, sn="n_nationkey", seller="n_name", r="n_regionkey"),
    ).groupBy("buyer", "seller").agg(F.count("*").alias("lines"))


_GOODS = [{"word": "ring", "family": "metal"}, {"word": "small", "family": "size"},
          {"word": "large", "family": "size"}]


@query("""SELECT p_partkey, family FROM (
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
  JOIN (VALUES ('ring', 'metal'), ('small', 'size'), ('large', 'size')) AS g(word, family)
    USING (word)""")
def explode_join(spark, sf_dir):
    words = logs.table(spark, sf_dir, "part").withColumn("words", F.split("p_name", " "))
    goods = relational.rel(spark, _GOODS, "word string, family string")
    return unify(
        relational.unnest(words, "words", "word").select("p_partkey", "word"), F.broadcast(goods)
    ).select("p_partkey", "family")


@query("""WITH brands AS (SELECT p_brand AS brand, CAST(round(avg(CAST(p_retailprice
    AS DECIMAL(18,2))), 2) AS DOUBLE) AS typical FROM part GROUP BY p_brand)
  SELECT brand, count(*) AS dearer_parts FROM part JOIN brands ON p_retailprice > typical
  GROUP BY brand""")
def theta_join(spark, sf_dir):
    part = logs.table(spark, sf_dir, "part")
    brands = part.groupBy(F.col("p_brand").alias("brand")).agg(
        F.round(F.avg(F.col("p_retailprice").cast("decimal(18,2)")), 2).cast("double").alias("typical"))
    prices = part.select(F.col("p_retailprice").cast("double").alias("price"))
    return relational.count_above(prices, "price", brands, "typical", 10.0, "dearer_parts").where(
        "dearer_parts > 0").select("brand", "dearer_parts")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice, p_partkey, p_retailprice
  FROM lineitem JOIN part ON l_extendedprice < p_retailprice""")
def theta_join_rows(spark, sf_dir):
    """Lines sold for less than a part costs, with every such part."""
    lines = logs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    parts = logs.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return theta.theta_join(lines, "<", parts, "l_extendedprice", "p_retailprice")


@query("""SELECT s_suppkey AS supplier, r_name AS region, n_regionkey = r_regionkey AS home
  FROM supplier JOIN nation ON s_nationkey = n_nationkey CROSS JOIN region""")
def cross_join(spark, sf_dir):
    home = unify(
        bind(logs.table(spark, sf_dir, "supplier"), supplier="s_suppkey", n="s_nationkey"),
        bind(logs.table(spark, sf_dir, "nation"), n="n_nationkey", home="n_regionkey"))
    regions = bind(logs.table(spark, sf_dir, "region"), r="r_regionkey", region="r_name")
    return unify(home, relational.literal(regions)).select(
        "supplier", "region", (F.col("home") == F.col("r")).alias("home"))


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (
    SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey LIMIT 100)""")
def semi_join_limited(spark, sf_dir, n=100):
    building = logs.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    orders = logs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return relational.semi_join_first(orders, "o_custkey", building, n, "c_custkey").select(
        "o_orderkey", "o_custkey", "o_totalprice")


AS_OF_JOIN_AT = "1998-06-01 12:00:00"


@query(f"""WITH o_log AS ({logs.ORDERS_SQL}), l_log AS ({logs.LINES_SQL}),
  {logs.as_of_cte('o_log', 'o', AS_OF_JOIN_AT)}, {logs.as_of_cte('l_log', 'l', AS_OF_JOIN_AT)}
  SELECT o.o_orderkey, o_orderstatus, o_totalprice, l_linenumber, l._id AS line_id,
    l_extendedprice, l_discount FROM o JOIN l ON o.o_orderkey = l.l_orderkey""")
def as_of_join(spark, sf_dir, instant=AS_OF_JOIN_AT):
    state = travel.Snapshot(
        {"orders": logs.orders_log(spark, sf_dir), "lineitem": logs.lines_log(spark, sf_dir)}, instant)
    lines = state["lineitem"].withColumnRenamed(ID, "line_id")
    return state["orders"].join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "l_linenumber", "line_id",
        "l_extendedprice", "l_discount")


@query("""SELECT o.o_orderkey, n.o_orderkey AS sequel, n.o_totalprice AS sequel_price
  FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderkey + 1 END AS sequel
    FROM orders) o JOIN orders n ON o.sequel = n.o_orderkey""")
def self_reference_join(spark, sf_dir):
    """Rows whose column refers to another row of the same table, or to none."""
    orders = logs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    first = orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey") + 1).alias("sequel"))
    second = orders.select(
        F.col("o_orderkey").alias("sequel"), F.col("o_totalprice").alias("sequel_price"))
    return first.join(second, "sequel").select("o_orderkey", "sequel", "sequel_price")


@query("""SELECT doc AS doc_id, quality FROM (
    SELECT d.doc_id, CASE WHEN lang = 'en' THEN NULL ELSE d.doc_id END AS doc FROM documents d)
  JOIN labels l ON doc = l.doc_id""")
def scalar_key_join(spark, sf_dir):
    """A key that is an array in some rows: those rows have no scalar and do not join."""
    from tidemark.functions import nested

    documents = logs.table(spark, sf_dir, "documents").select("doc_id", "lang")
    as_json = F.when(F.col("lang") == "en", F.concat(F.lit("["), "doc_id", F.lit("]"))).otherwise(
        F.col("doc_id").cast("string"))
    mixed = documents.select(F.parse_json(as_json).alias("ref"))
    keyed = mixed.select(nested.scalar_key("ref").alias("doc_id"))
    labels = logs.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return keyed.join(labels, "doc_id").select("doc_id", "quality")


@query("""SELECT c_custkey AS custkey, c_name AS name, c_acctbal AS balance FROM customer
  ORDER BY c_acctbal DESC, c_custkey LIMIT 1""")
def nest_one(spark, sf_dir):
    richest = logs.table(spark, sf_dir, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(1)
    return relational.nest_one(richest, "customer").select(
        F.col("customer.c_custkey").alias("custkey"), F.col("customer.c_name").alias("name"),
        F.col("customer.c_acctbal").alias("balance"))

"""Ready reports and correction jobs over versioned and plain tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.columns import ID, VALID_FROM, VALID_TO, instant_literal, instant_type
from tidemark.operators import dml
from tidemark.operators.travel import VersionedTable, with_status


MILLION = 1_000_000
#: Instants of a trend that one pass tells apart.
TOGETHER = 48


def millionths(column: Column) -> Column:
    """A money expression in whole millionths: sums of it do not depend on row order.

    Rounding a double to a whole number is much cheaper than casting it to a decimal
    with places.
    """
    return F.floor(column * MILLION + 0.5).cast("decimal(18,0)")


def money(total: Column) -> Column:
    """A sum of millionths as an amount rounded to cents."""
    return F.round(total / F.lit(MILLION), 2).cast("double")


def local_supplier_volume(
    customer: DataFrame, orders: DataFrame, lineitem: DataFrame, supplier: DataFrame,
    nation: DataFrame, region: DataFrame, region_name: str, start: str, years: int = 1,
) -> DataFrame:
    """Revenue per nation of a region where customer and supplier share the nation.

    The date range is half-open.  Filters come first, so region and nation reduce
    customers and suppliers before the line items are touched.
    """
    first = F.lit(start).cast("timestamp_ntz")
    after = first + F.make_ym_interval(F.lit(years))
    nations = nation.join(
        region.where(F.col("r_regionkey").isNotNull() & (F.col("r_name") == region_name)),
        F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name")
    placed = orders.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < after))
    buyers = customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_nationkey", "n_name")
    bought = placed.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_nationkey", "n_name")
    lines = lineitem.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
    local = lines.join(
        supplier,
        (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    revenue = F.sum(millionths(F.col("l_extendedprice") * (1 - F.col("l_discount"))))
    return local.groupBy("n_name").agg(money(revenue).alias("revenue")).orderBy(F.desc("revenue"))


_TOTALS = ("_orders", "_lines", "_revenue", "_price", "_discount")


def _line_totals(lineitem: DataFrame, by: Sequence[str]) -> DataFrame:
    return lineitem.groupBy(*by).agg(
        F.count("*").alias("_lines"),
        F.sum(millionths(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("_revenue"),
        F.sum(millionths(F.col("l_extendedprice"))).alias("_price"),
        F.sum(millionths(F.col("l_discount"))).alias("_discount"),
    )


def _add_up(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.sum(t).alias(t) for t in _TOTALS])


def _billing_columns() -> list[Column]:
    """The report's measures from totals that may be missing altogether."""
    lines = F.coalesce("_lines", F.lit(0))

    def mean(total: str, places: str) -> Column:
        average = F.round(F.col(total) / (F.col("_lines") * MILLION), 2)
        return F.coalesce(
            F.when(lines > 0, average.cast(places).cast("double")), F.lit(0.0))

    return [
        F.coalesce("_orders", F.lit(0)).alias("order_count"),
        lines.alias("line_item_count"),
        F.coalesce(money(F.col("_revenue")), F.lit(0.0)).alias("total_revenue"),
        mean("_price", "decimal(12,2)").alias("avg_line_price"),
        mean("_discount", "decimal(4,2)").alias("avg_discount"),
    ]


def billing_report(customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Per customer: balance, orders, lines, revenue and averages, at one instant.

    Inputs are same-instant views with one row per order, so distinct orders are a
    plain count.  Lines are totalled per order first and orders per customer next;
    each step shrinks what the following join moves, and a customer with very many
    lines is aggregated before its rows meet in one task.
    """
    lines = _line_totals(lineitem, ["l_orderkey"])
    per_order = orders.select("o_orderkey", "o_custkey", F.lit(1).alias("_orders")).join(
        lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    per_customer = _add_up(per_order, ["o_custkey"])
    return customer.join(
        per_customer, F.col("c_custkey") == F.col("o_custkey"), "left"
    ).select(
        "c_custkey", "c_name", F.col("c_acctbal").alias("customer_balance"), *_billing_columns())


def billing_trend(
    customer: VersionedTable, orders: VersionedTable, lineitem: VersionedTable,
    instants: Sequence[str],
) -> DataFrame:
    """The billing totals of the whole book at several instants, in one job.

    Rows travel with the set of instants they are valid at, not once for each. Totals shrink to one row per order
    and set, then per customer and set, before each join; sets are intersected by joins and told apart at the end.
    """
    moments = list(dict.fromkeys(instants))
    if len(moments) > TOGETHER:
        parts = [billing_trend(customer, orders, lineitem, moments[k:k + TOGETHER]) for k in range(0, len(moments), TOGETHER)]
        return reduce(DataFrame.unionByName, parts).dropDuplicates(["as_of"])
    kind = instant_type(customer.log)
    bits = [F.when(F.col("_at").bitwiseAND(F.lit(1 << k)) != 0, instant_literal(t, kind)) for k, t in enumerate(moments)]
    as_of = F.explode(F.array_distinct(F.array_compact(F.array(*bits)))).alias("as_of")
    buyers = customer.columns("c_custkey").as_of_sets(moments).select("_at", "c_custkey")
    placed = orders.columns("o_orderkey", "o_custkey").as_of_sets(moments).select("_at", "o_orderkey", "o_custkey")
    sold = lineitem.columns("l_orderkey", "l_extendedprice", "l_discount").as_of_sets(moments)
    lines = _line_totals(sold, ["_at", "l_orderkey"]).withColumnRenamed("_at", "_line_at")
    both = placed.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).withColumn(
        "_at", F.col("_at").bitwiseAND(F.col("_line_at"))).where("_at != 0")
    facts = placed.select("_at", "o_custkey", F.lit(1).alias("_orders")).unionByName(
        both.select("_at", "o_custkey", *[t for t in _TOTALS if t != "_orders"]), allowMissingColumns=True)
    known = buyers.groupBy("c_custkey").agg(F.bit_or("_at").alias("_buyer_at"))
    per_customer = _add_up(facts, ["_at", "o_custkey"]).join(known, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "_at", F.col("_at").bitwiseAND(F.col("_buyer_at")))
    totals = _add_up(_add_up(per_customer, ["_at"]).select(as_of, *_TOTALS), ["as_of"])
    customers = buyers.groupBy("_at").agg(F.count("*").alias("customers")).select(as_of, "customers").groupBy(
        F.col("as_of").alias("_buyer_at")).agg(F.sum("customers").alias("customers"))
    return customers.join(totals, F.col("_buyer_at") == F.col("as_of"), "left").select(
        F.col("_buyer_at").alias("as_of"), "customers", *_billing_columns())


def evolution(
    table: VersionedTable, columns: Sequence[str], before: str, limit: int
) -> DataFrame:
    """The first versions starting before an instant, oldest first, with their status."""
    found = table.columns(*columns).all_versions().where(
        F.col(VALID_FROM) < F.lit(before).cast("timestamp_ntz"))
    return (
        with_status(found).select(ID, *columns, VALID_FROM, VALID_TO, "status")
        .orderBy(VALID_FROM, ID).limit(limit)
    )


@dataclass(frozen=True)
class Correction:
    """One bulk correction: which columns change and which current rows it touches."""

    changes: Mapping[str, Column]
    where: Column | None = None


def bulk_corrections(
    tables: Mapping[str, VersionedTable], rules: Mapping[str, Correction], tx: int, at
) -> dict[str, VersionedTable]:
    """Several tables after one transaction that corrects them from ``at`` on."""
    return {
        name: tables[name].update(rule.changes, tx, at, rule.where)
        for name, rule in rules.items()
    }


def drift(
    table: VersionedTable, days: Sequence[str], changes, first_tx: int
) -> DataFrame:
    """Versions added by a daily job that derives each day's values from the day before.

    ``changes(number)`` gives the column expressions of a day; numbers start at 2, the
    first day being the initial state.  The chain is one projection over one read of
    the initial rows, not a job per day.
    """
    state = table.as_of(days[0])
    parts = []
    for number, day in enumerate(days[1:], 2):
        state = state.withColumns(changes(number))
        parts.append(dml.put(state, first_tx + number, day, distinct_ids=True))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result

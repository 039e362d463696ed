"""The shape of physical plans: what scale depends on."""

import pytest

from tidemark.operators import dml
from tidemark.plans import resolve
from tidemark.queries import all_queries, logs
from tidemark.queries.temporal import EARLY

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", all_queries())
def test_no_products(spark, name):
    text = plan(all_queries()[name][0](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_as_of_limits_below_the_shuffle_and_pushes_filters(spark):
    text = plan(logs.events_log(spark, SF_DIR).as_of(EARLY).select("event_type"))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert "Partial" in text and "LessThanOrEqual(ts," in text
    # Only the wanted payload column is read.
    assert "value" not in text.split("ReadSchema")[1]


def test_open_plan_is_one_shuffle_in_the_jvm(spark):
    text = plan(logs.late_log(spark, SF_DIR).columns("event_type").all_versions())
    assert text.count("Exchange") == 1 and "InArrow" not in text
    assert text.count("Sort [") == 1


def test_id_filter_passes_resolution(spark):
    found = logs.late_log(spark, SF_DIR).columns("event_type").all_versions().where("_id = 5")
    assert "EqualTo(user_id,5)" in plan(found)


def test_large_ids_are_split(spark):
    table = logs.portion_log(spark, SF_DIR).columns("event_type")
    text = plan(resolve.versions(table.log, rows_per_task=5))
    assert "hashpartitioning(_id" in text and "_chunk" in text


def test_money_columns_of_orders_are_pruned(spark):
    text = plan(dml.update(
        logs.orders_initial(spark, SF_DIR).columns("o_orderstatus").log, {}, 2,
        "2002-01-01 00:00:00", open_ended=True))
    assert "o_totalprice" not in text

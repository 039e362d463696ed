"""Tables whose ids are split into chunks give the same answers as whole ones."""

from dataclasses import replace
from itertools import islice

import pytest
from pyspark.sql import functions as F

from tidemark.columns import ID, VALID_FROM, VALID_TO
from tidemark.operators import dml
from tidemark.queries import logs
from tidemark.queries.temporal import EARLY, LATER

SF_DIR = "/root/testdata/sf0.001"
AT = "2024-01-15 00:00:00"


def shown(table):
    df = table.all_versions().select(ID, VALID_FROM, VALID_TO, "event_type", "value")
    return sorted((tuple(r) for r in df.collect()), key=repr)


def statements(table, events):
    ids = events.where("event_type = 'purchase'").select(F.col("user_id").alias(ID))
    patches = events.groupBy(F.col("user_id").alias(ID)).agg(F.max("value").alias("value"))
    yield "read", table
    yield "update", table.update(
        {"value": F.col("value") * 2}, 10**9, AT, F.col("event_type") == "purchase")
    yield "portion", table.update({"value": F.lit(0.0)}, 10**9, EARLY, until=LATER)
    yield "delete", table.delete_where(F.col("value") > 50, 10**9, AT)
    yield "ids", replace(
        table.after_puts(dml.delete_ids(ids, 10**9, AT, EARLY, LATER)), open_ended=False)
    yield "patch", table.patch(patches, 10**9, AT)


@pytest.mark.parametrize("log,first", [(logs.late_log, 2), (logs.portion_log, 6)])
def test_statements_on_split_ids(spark, log, first):
    events = logs.table(spark, SF_DIR, "events")
    whole = log(spark, SF_DIR).columns("event_type", "value")
    # One user holds about a third of all writes.
    skewed = whole.log.withColumn(ID, F.when(F.col(ID) % 3 == 0, 0).otherwise(F.col(ID)))
    whole = replace(whole, log=skewed)
    split = replace(whole, rows_per_task=20)
    assert split.profiled().prof.hot
    pairs = zip(statements(whole, events), statements(split, events))
    for (name, a), (_, b) in islice(pairs, first):
        assert shown(a) == shown(b), name

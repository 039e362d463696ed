"""Change-data-capture events built from the events table, in all their forms."""

from pyspark.sql import functions as F

from tidemark.columns import ID, VALID_FROM, VALID_TO
from tidemark.functions import nested
from tidemark.operators.travel import VersionedTable
from tidemark.queries import logs
from tidemark.queries.logs import as_of_cte, versions_ctes
from tidemark.queries.registry import query
from tidemark.sources import cdc

NOW = "2024-02-01 00:00:00"

_OP = """CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'u' WHEN 'click' THEN 'u'
  WHEN 'view' THEN 'r' ELSE 'd' END"""
_MILLIS = "CAST(unix_timestamp(ts) AS BIGINT) * 1000 + CAST(date_format(ts, 'SSS') AS BIGINT)"
_ROW = """named_struct('id', user_id, 'kind', event_type, 'amount', value, '__hidden', 1)"""
_DELETE = "event_type = 'error'"


def _row_when(condition: str) -> str:
    return f"IF({condition}, {_ROW}, NULL)"


def envelope_events(spark, sf_dir):
    """Full envelopes; clicks arrive wrapped in a payload with their own time."""
    events = logs.table(spark, sf_dir, "events")
    source = f"named_struct('db', 'shop', 'table', 'user states', 'ts_ms', {_MILLIS})"
    body = f"""named_struct('op', {_OP}, 'source', {source}, 'ts_ms', {_MILLIS},
        'before', {_row_when(_DELETE)}, 'after', {_row_when(f'NOT ({_DELETE})')})"""
    text = F.when(
        F.col("event_type") == "click", F.expr(f"to_json(named_struct('payload', {body}))")
    ).otherwise(F.expr(f"to_json({body})"))
    return events.select(F.col("event_id").alias("_position"), text.alias("event"))


def flat_events(spark, sf_dir):
    events = logs.table(spark, sf_dir, "events")
    text = F.expr(f"""to_json(named_struct('id', user_id, 'kind', event_type, 'amount', value,
        '__op', IF({_DELETE}, 'u', {_OP}), '__table', 'main.shop.states',
        '__source_ts_ms', CAST({_MILLIS} AS STRING), '__deleted', IF({_DELETE}, 'true', 'false')))""")
    return events.select(F.col("event_id").alias("_position"), text.alias("event"))


_MOMENT = "date_trunc('millisecond', ts)"
_NORMALISED = f"""event_id AS seq, {_OP} AS op, CAST(user_id AS VARCHAR) AS record_id,
  {_MOMENT} AS valid_from, event_type AS kind, value AS amount FROM events"""


def _shown(found):
    return found.select(
        F.col("_seq").alias("seq"), "form", "op", "table", "record_id", "valid_from", "deleted",
        nested.path("data", "kind").alias("kind"),
        nested.path("data", "amount", as_type="double").alias("amount"))


@query(f"""SELECT CASE WHEN event_type = 'click' THEN 'wrapped' ELSE 'envelope' END AS form,
  'userstates' AS "table", event_type = 'error' AS deleted, {_NORMALISED}""")
def cdc_normalize(spark, sf_dir):
    return _shown(cdc.accepted(cdc.normalise(envelope_events(spark, sf_dir), NOW)))


@query(f"""SELECT 'flat' AS form, 'states' AS "table", event_type = 'error' AS deleted,
  {_NORMALISED.replace(_OP, f"CASE WHEN event_type = 'error' THEN 'u' ELSE {_OP} END")}""")
def cdc_flat_normalize(spark, sf_dir):
    return _shown(cdc.accepted(cdc.normalise(flat_events(spark, sf_dir), NOW)))


@query("""SELECT reject_reason, count(*) AS n FROM (SELECT CASE
    WHEN value < 10 THEN 'empty value' WHEN value < 20 THEN 'not json'
    WHEN value < 30 THEN 'no source' WHEN value < 40 THEN 'schema event'
    WHEN value < 50 THEN 'no payload' WHEN value < 60 THEN 'no table'
    WHEN value < 70 THEN 'no id' WHEN value < 80 THEN 'no data'
    WHEN value < 90 THEN 'unknown op' END AS reject_reason FROM events)
  WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")
def cdc_rejects(spark, sf_dir):
    """Every way an event can fail to be a write, spread over the whole table by value."""
    forms = [
        (10, ""), (20, "{broken"), (30, '{"source": null, "op": "c", "after": {"id": 1}}'),
        (40, '{"source": {"table": "t"}, "ddl": "ALTER", "after": {"id": 1}}'),
        (50, '{"source": {"table": "t"}, "op": "c"}'),
        (60, '{"source": {"table": ""}, "op": "c", "after": {"id": 1}}'),
        (70, '{"source": {"table": "t"}, "op": "c", "after": {"id": null}}'),
        (80, '{"source": {"table": "t"}, "op": "d", "before": null, "after": {"id": 1}}'),
        (90, '{"source": {"table": "t"}, "op": "x", "after": {"id": 1}}'),
    ]
    text = F.lit('{"source": {"table": "t"}, "op": "c", "after": {"id": 1}}')
    for below, form in reversed(forms):
        text = F.when(F.col("value") < below, form).otherwise(text)
    events = logs.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_position"), text.alias("event"))
    return cdc.rejected(cdc.normalise(events, NOW)).groupBy("reject_reason").agg(
        F.count("*").alias("n"))


@query(f"""SELECT 'userstates' AS "table", CASE event_type WHEN 'signup' THEN 'insert'
    WHEN 'error' THEN 'delete' WHEN 'view' THEN 'snapshot' ELSE 'update' END AS operation,
  count(*) AS n FROM events GROUP BY ALL""")
def cdc_op_tally(spark, sf_dir):
    return cdc.tally(cdc.normalise(envelope_events(spark, sf_dir), NOW))


_CDC_LOG = f"""log AS (SELECT CAST(user_id AS VARCHAR) AS _id, {_MOMENT} AS _valid_from,
  CAST(NULL AS TIMESTAMP) AS _valid_to, CAST(0 AS BIGINT) AS _tx, event_id AS _seq,
  CASE WHEN event_type = 'error' THEN 'delete' ELSE 'put' END AS _op,
  event_type AS kind, value AS amount FROM events)"""


def _applied(events):
    log = cdc.to_log(cdc.normalise(events, NOW), 0, NOW)
    return VersionedTable(log.drop("table"), open_ended=True)


def _promoted(df, *also):
    return df.select(
        ID, nested.path("doc", "kind").alias("kind"),
        nested.path("doc", "amount", as_type="double").alias("amount"), *also)


@query(f"WITH {_CDC_LOG}, {as_of_cte('log', 'state', NOW)} SELECT _id, kind, amount FROM state")
def cdc_apply_current(spark, sf_dir):
    return _promoted(_applied(envelope_events(spark, sf_dir)).current(NOW))


@query(f"""WITH {_CDC_LOG}, {versions_ctes('log', 'versions')}
  SELECT _id, kind, amount, _valid_from, _valid_to FROM versions""")
def cdc_apply_history(spark, sf_dir):
    return _promoted(
        _applied(flat_events(spark, sf_dir)).all_versions(), VALID_FROM, VALID_TO)

"""Change events from a stream into the log store.

Each micro-batch is one transaction.  Rows go to ``commit=<tx>`` directories that a
replayed batch overwrites, and the transaction row comes last, so a restart neither
loses nor doubles anything.  Bad events go to ``rejects``; any other error fails the
batch, which Spark then runs again.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.columns import ID, VALID_FROM
from tidemark.operators.travel import VersionedTable
from tidemark.sources import cdc
from tidemark.sources.store import LogStore


def from_files(spark: SparkSession, directory: str) -> DataFrame:
    """JSON-lines files appearing in a directory, one event per line."""
    return cdc.placed_lines(spark.readStream.format("text").load(directory))


def from_kafka(spark: SparkSession, servers: str, topics: str, **options: str) -> DataFrame:
    """A Kafka topic per table; needs Spark's Kafka package on the class path."""
    stream = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", topics).options(**options).load()
    )
    return stream.select(
        F.col("value").cast("string").alias("event"), "partition", "offset",
        F.col("timestamp").alias("received"))


def without_redelivered(events: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """Drop events delivered again within ``delay`` of their first arrival.

    ``keys`` identify an event.  The time that counts is that of arrival, so an event is
    never too late, whatever its own time says.  State holds the keys of the events that
    arrived within ``delay``.
    """
    received = events.withColumn("_received_at", F.current_timestamp()).withWatermark("_received_at", delay)
    return received.dropDuplicatesWithinWatermark(keys).drop("_received_at")


def apply(
    events: DataFrame,
    store: LogStore,
    checkpoint: str,
    first_tx: int = 0,
    id_field: str = "id",
    monitor: tuple[str, ...] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start writing a stream with a column ``event`` into the store.

    ``first_tx`` is added to Spark's batch number and must stay the same over
    restarts.  Tables named in ``monitor`` get a row of counts per batch.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        tx = first_tx + number
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        position = "offset" if "offset" in batch.columns else "_position"
        if set(cdc.PLACE) <= set(batch.columns):
            batch = cdc.in_order(batch)
        if position not in batch.columns:
            raise ValueError("events need a position: a column offset or _position, or files")
        found = cdc.normalise(batch, now, position=position, id_field=id_field)
        store.write_routed(tx, cdc.to_log(found, tx, now, id_field))
        cdc.rejected(found).select(
            "_seq", "form", "op", "table", "record_id", "reject_reason",
            F.to_json("data").alias("data"),
        ).write.mode("overwrite").parquet(f"{store.root}/rejects/commit={tx}")
        store.commit(tx, now)
        for table in monitor:
            record_counts(store, table, tx, now)

    writer = events.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


MONITOR_SCHEMA = "table_name string, _tx bigint, current_count bigint, change bigint, newest array<string>"


def look(table: VersionedTable, now) -> tuple[int, list[str]]:
    """Current count and the ids of the three newest versions: four values in all."""
    narrow = table.columns()
    newest = narrow.all_versions().orderBy(F.desc(VALID_FROM), F.asc(ID)).select(ID).limit(3)
    return narrow.as_of(now).count(), [str(r[0]) for r in newest.collect()]


def record_counts(store: LogStore, name: str, tx: int, now) -> None:
    """Append count, change since the last look and newest ids to the monitor log."""
    seen = monitor_log(store).where((F.col("table_name") == name) & (F.col("_tx") < tx))
    last = seen.orderBy(F.desc("_tx")).select("current_count").first()
    count, newest = look(store.table(name, basis=tx, open_ended=True), now)
    row = [(name, tx, count, count - (last[0] if last else 0), newest)]
    store.spark.createDataFrame(row, MONITOR_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{store.root}/monitor/watched={name}/commit={tx}")


def monitor_log(store: LogStore) -> DataFrame:
    return store._read("monitor", MONITOR_SCHEMA)

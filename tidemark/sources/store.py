"""Write logs on Parquet, with atomic transactions.

Layout below ``root``::

    log/table=<name>/gen=<g>/commit=<tx>/   rows of one transaction
    txs/commit=<tx>/                        written last: the transaction counts now
    erasures/commit=<tx>/                   ids erased by the transaction
    generations/table=<name>/gen=<g>/       a finished rewrite of a table

Readers take only rows whose transaction is in ``txs``, so a job that dies half
way leaves nothing visible, and running it again overwrites its own directories.
One writer at a time is assumed.  Everything goes through Spark's file sources, so
any file system Spark reaches will do.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.columns import ID, LOG_COLUMNS, TX, VALID_TO, instant_literal
from tidemark.functions.names import table_identifier
from tidemark.operators.travel import VersionedTable
from tidemark.plans import visibility

TX_SCHEMA = "_tx bigint, system_time timestamp_ntz, committed boolean"
# Directory of a rewritten generation, which holds many transactions.
REWRITTEN = -1
ERASE_SCHEMA = "_table string, _id string, _tx bigint"


class LogStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _read(self, path: str, schema: str) -> DataFrame:
        names = [f.split()[0] for f in schema.split(",")]
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{path}").select(*names)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    # -- writing ---------------------------------------------------------------

    def next_tx(self) -> int:
        last = self.txs().agg(F.max(TX)).first()[0]
        return 0 if last is None else last + 1

    def write_rows(self, tx: int, table: str, rows: DataFrame) -> None:
        """Stage rows of a transaction; invisible until ``commit``."""
        path = f"{self.root}/log/table={table_identifier(table)}/gen={self.generation(table)}/commit={tx}"
        stamped = rows.withColumn(TX, F.lit(tx).cast("bigint"))
        stamped.write.mode("overwrite").parquet(path)

    def write_routed(self, tx: int, rows: DataFrame) -> None:
        """Stage rows of many tables, named by column ``table``, in one job."""
        generations = self.generations()
        gen = F.lit(0)
        if generations:
            pairs = [F.lit(x) for item in generations.items() for x in item]
            gen = F.coalesce(F.create_map(*pairs)[F.col("table")], gen)
        stamped = rows.withColumns({
            TX: F.lit(tx).cast("bigint"), "gen": gen, "commit": F.lit(tx)})
        (
            stamped.hint("rebalance", "table")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("table", "gen", "commit").parquet(f"{self.root}/log")
        )

    def write_erasures(self, tx: int, table: str, ids: DataFrame) -> None:
        rows = ids.select(
            F.lit(table).alias("_table"), F.col(ID).cast("string").alias(ID),
            F.lit(tx).cast("bigint").alias(TX)).distinct()
        rows.write.mode("overwrite").parquet(f"{self.root}/erasures/commit={tx}/table={table}")

    def commit(self, tx: int, system_time) -> None:
        """Make a transaction visible.  Repeating it changes nothing."""
        row = self.spark.range(1).select(
            F.lit(tx).cast("bigint").alias(TX),
            instant_literal(system_time, T.TimestampNTZType()).alias("system_time"),
            F.lit(True).alias("committed"))
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/txs/commit={tx}")

    def transact(
        self, system_time, puts: Mapping[str, DataFrame], tx: int | None = None
    ) -> int:
        """Log rows for one or more tables as one transaction."""
        tx = self.next_tx() if tx is None else tx
        for table, rows in puts.items():
            self.write_rows(tx, table, rows)
        self.commit(tx, system_time)
        return tx

    # -- reading ---------------------------------------------------------------

    def txs(self) -> DataFrame:
        return self._read("txs", TX_SCHEMA)

    def generations(self) -> dict[str, int]:
        """Current generation of each rewritten table: one entry per table."""
        rows = self._read("generations", "table string, gen int").groupBy("table").agg(
            F.max("gen").alias("gen"))
        return {r["table"]: r["gen"] for r in rows.collect()}

    def generation(self, table: str) -> int:
        return self.generations().get(table_identifier(table), 0)

    def _table_path(self, table: str) -> str:
        return f"{self.root}/log/table={table_identifier(table)}/gen={self.generation(table)}"

    def raw_log(self, table: str) -> DataFrame:
        """All staged rows, committed or not; columns are the union over commits."""
        return self.spark.read.option("mergeSchema", True).parquet(self._table_path(table))

    def staged(self, table: str) -> list[int]:
        """Transactions with rows of the table on disk that were never committed.

        Known from directory names; there are as many as jobs that died, not as many
        as transactions.
        """
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
            "pathGlobFilter", "*.parquet").load(self._table_path(table))
        commits = files.select(
            F.regexp_extract("path", r"/commit=(-?\d+)/", 1).cast("bigint").alias(TX)).distinct()
        open_txs = commits.where(F.col(TX) != REWRITTEN).join(self.txs(), TX, "left_anti")
        return [r[TX] for r in open_txs.collect()]

    def erasures(self, table: str, id_type="string") -> DataFrame:
        rows = self._read("erasures", ERASE_SCHEMA).where(F.col("_table") == table)
        done = visibility.committed(rows.select(ID, TX), self.txs())
        return done.withColumn(ID, F.col(ID).cast(id_type))

    def table(
        self, name: str, basis: int | None = None, open_ended: bool | None = None
    ) -> VersionedTable:
        """The committed part of a table.

        Uncommitted transactions are whole directories, so leaving them out prunes
        partitions; rows are not joined with the transaction table.  Unless told, the
        store looks for bounded writes; files without any are skipped by their statistics.
        """
        log = self.raw_log(name)
        staged = self.staged(name)
        if staged:
            log = log.where(~F.col("commit").isin(staged))
        log = log.drop("commit")
        if open_ended is None:
            open_ended = not log.where(F.col(VALID_TO).isNotNull()).select(VALID_TO).take(1)
        return VersionedTable(
            log, open_ended=open_ended,
            erasures=self.erasures(name, log.schema[ID].dataType), basis=basis,
            clock=self.txs())

    def list_tables(self) -> DataFrame:
        """Names of stored tables, from directory names alone."""
        paths = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
            "pathGlobFilter", "*.parquet").load(f"{self.root}/log").select("path")
        return paths.select(
            F.regexp_extract("path", r"/table=([^/]+)/", 1).alias("table_name")).distinct()

    # -- maintenance -----------------------------------------------------------

    def rewrite(self, name: str) -> int:
        """Rewrite a table without erased and uncommitted rows, in fewer larger files.

        The new generation counts once its marker is written; a failed rewrite
        leaves the old one in force.  Old directories are then safe to remove.
        """
        table = table_identifier(name)
        gen = self.generation(name) + 1
        kept = self.table(name).visible()
        order = [c for c in LOG_COLUMNS if c in kept.columns]
        kept = kept.select(*order, *[c for c in kept.columns if c not in order])
        kept.repartitionByRange(ID, TX).sortWithinPartitions(ID, TX).write.mode(
            "overwrite").parquet(f"{self.root}/log/table={table}/gen={gen}/commit={REWRITTEN}")
        self.spark.range(1).select(F.lit(1).alias("done")).coalesce(1).write.mode(
            "overwrite").parquet(f"{self.root}/generations/table={table}/gen={gen}")
        return gen

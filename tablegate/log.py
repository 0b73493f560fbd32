"""The validation log: runs, checks and source reconciliation snapshots.

These three tables are append-only. A run writes a row when it starts and another one when it
ends; readers see the latest row of each run. Nothing is rewritten, so a lost executor or a
failed append leaves earlier rows as they were.

The closing row of a run publishes what it logged. Rows of an attempt that was killed before it
closed, or that ended in an error and was tried again, stay in the tables but are not read.

Totals of checks by day are kept beside them. They are the one table that is rewritten, by whole days.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablegate.config import ConfigError, Status
from tablegate.reports import day_totals

# The columns of the log tables.
RUN_COLUMNS = """
    run_id STRING NOT NULL, pipeline_run_id STRING, batch_id STRING, table_name STRING,
    tier TINYINT NOT NULL, tier_name STRING NOT NULL, started_at TIMESTAMP NOT NULL,
    completed_at TIMESTAMP, status STRING NOT NULL, total_checks INT, passed_checks INT,
    failed_checks INT, warned_checks INT, error_message STRING, run_by STRING, env STRING
"""
CHECK_COLUMNS = """
    check_id STRING NOT NULL, run_id STRING NOT NULL, pipeline_run_id STRING, batch_id STRING,
    checked_at TIMESTAMP NOT NULL, tier TINYINT NOT NULL, tier_name STRING NOT NULL,
    table_name STRING NOT NULL, check_name STRING NOT NULL, check_category STRING NOT NULL,
    check_description STRING, status STRING NOT NULL, severity STRING NOT NULL,
    expected_value DOUBLE, actual_value DOUBLE, variance_value DOUBLE, variance_pct DOUBLE,
    failure_count BIGINT, failure_sample STRING, sql_query STRING, execution_ms BIGINT
"""
SNAPSHOT_COLUMNS = """
    snapshot_id STRING NOT NULL, run_id STRING NOT NULL, snapshot_date DATE NOT NULL,
    table_name STRING NOT NULL, metric_name STRING NOT NULL, source_value DOUBLE,
    silver_value DOUBLE, variance_value DOUBLE, variance_pct DOUBLE, within_threshold BOOLEAN,
    threshold_pct DOUBLE
"""
DAY_COLUMNS = """
    tier_name STRING, table_name STRING, check_name STRING, run_count BIGINT, passed BIGINT,
    failed BIGINT, warned BIGINT, timed BIGINT, total_ms BIGINT, max_ms BIGINT
"""


@dataclass(frozen=True)
class LogTable:
    name: str
    columns: str
    partitions: tuple[str, ...]

    @property
    def schema(self) -> str:
        """Columns as a DDL schema; the date of a check is a column of its own for pruning."""
        text = " ".join(self.columns.split())
        return f"{text}, check_date DATE" if "check_date" in self.partitions else text


RUN = LogTable("validation_run", RUN_COLUMNS, ("tier",))
CHECK = LogTable("validation_check", CHECK_COLUMNS, ("tier", "check_date"))
SNAPSHOT = LogTable("validation_source_recon_snapshot", SNAPSHOT_COLUMNS, ("snapshot_date",))
DAY = LogTable("validation_check_day", DAY_COLUMNS, ("check_date",))
LOG_TABLES = (RUN, CHECK, SNAPSHOT, DAY)
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def with_check_date(checks: DataFrame) -> DataFrame:
    return checks.withColumn("check_date", F.to_date("checked_at"))


def append(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Append to a partitioned folder, with few files per partition even if one is very large."""
    balanced = df.hint("rebalance", *[F.col(p) for p in partitions])
    balanced.write.mode("append").partitionBy(*partitions).parquet(path)


def upsert_latest(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``updates`` replacing those of the same key or added."""
    kept = target.join(updates.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(updates.select(*target.columns))


def latest_runs(events: DataFrame) -> DataFrame:
    """The last row written for each run: a finished one before the one that opened it."""
    order = Window.partitionBy("run_id").orderBy(F.col("completed_at").desc_nulls_last())
    return events.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= 1).drop("_rank")


def unpublished_runs(events: DataFrame) -> DataFrame:
    """run_id of runs whose rows do not count: those not closed, and errors that a later attempt replaces.

    An attempt is a run of the same pipeline run, batch, tier and tables; runs without a pipeline run are never
    replaced. A rerun after a result, even a failed one, replaces nothing.
    """
    attempt = [F.coalesce(c, F.lit("")).alias(c) for c in ("pipeline_run_id", "batch_id", "table_name")]
    runs = events.groupBy("run_id", "tier", *attempt).agg(
        F.struct(F.min("started_at").alias("started_at"), "run_id").alias("_at"),
        F.max("completed_at").alias("completed_at"),
        F.bool_or(F.col("status") == Status.ERROR.value).alias("_error"),
    )
    opened = runs.where("completed_at IS NULL")
    names = ["tier", "pipeline_run_id", "batch_id", "table_name"]
    closed = runs.where("completed_at IS NOT NULL AND pipeline_run_id <> ''")
    last = closed.groupBy(*names).agg(F.max("_at").alias("_last"))
    replaced = closed.where("_error").join(last, names).where("_at < _last")
    return opened.select("run_id").union(replaced.select("run_id"))


class ValidationLog:
    """The log tables, as catalog tables of a schema or as folders under a location."""

    def __init__(
        self,
        spark: SparkSession,
        location: str | None = None,
        schema: str | None = None,
        table_format: str = "parquet",
    ):
        if not (location or schema):
            raise ConfigError("a log needs a location or a schema")
        self.spark = spark
        self.location = location.rstrip("/") if location else None
        self.schema = schema
        self.table_format = table_format

    def ensure(self) -> ValidationLog:
        """Create the schema and tables, or the folders, that do not exist yet."""
        if not self.schema:
            for t in LOG_TABLES:
                append(self.spark.createDataFrame([], t.schema), self.path(t), t.partitions)
            return self
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self._quoted}")
        for t in LOG_TABLES:
            at = " LOCATION '{}'".format(self.path(t).replace("\\", "\\\\").replace("'", "\\'")) if self.location else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._quoted}.{t.name} ({t.schema}) "
                f"USING {self.table_format} PARTITIONED BY ({', '.join(t.partitions)}){at}"
            )
        return self

    @property
    def _quoted(self) -> str:
        """The schema with each part of its name quoted; dots part a catalog from a schema."""
        return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in self.schema.split("."))

    def path(self, table: LogTable) -> str:
        return f"{self.location}/{table.name}"

    def write(self, table: LogTable, df: DataFrame) -> None:
        if "check_date" in table.partitions:
            df = with_check_date(df)
        if not self.schema:
            append(df, self.path(table), table.partitions)
            return
        name = f"{self._quoted}.{table.name}"
        balanced = df.hint("rebalance", *[F.col(p) for p in table.partitions])
        balanced.select(*self.spark.table(name).columns).write.mode("append").insertInto(name)

    def read(self, table: LogTable) -> DataFrame:
        if self.schema:
            return self.spark.table(f"{self._quoted}.{table.name}")
        return self.spark.read.schema(table.schema).parquet(self.path(table))

    def runs(self) -> DataFrame:
        return latest_runs(self.read(RUN))

    def checks(self) -> DataFrame:
        """Published checks; rows of runs that the run table does not know count as published."""
        return self._published(CHECK)

    def snapshots(self) -> DataFrame:
        return self._published(SNAPSHOT)

    def _published(self, table: LogTable) -> DataFrame:
        rows = self.read(table)
        try:
            events = self.read(RUN)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return rows  # a folder log without any run
            raise
        return rows.join(unpublished_runs(events), "run_id", "left_anti").select(*rows.columns)

    def refresh_days(self, first: date, last: date) -> None:
        """Bring the totals of these days in line with the published checks, late ones included.

        Each day is replaced as a whole, so refreshing twice changes nothing. A reader that is at work on one of
        these days may have to read again.
        """
        within = F.col("check_date").between(F.lit(first), F.lit(last))
        # An empty row for each day, so that one without checks any more is replaced too.
        each = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("check_date")
        days = self.spark.range(1).select(each, F.lit(0).cast("bigint").alias("run_count"))
        found = day_totals(self.checks().where(within)).unionByName(days, allowMissingColumns=True)
        columns = self.read(DAY).columns
        found = found.select(*columns).hint("rebalance", F.col("check_date"))
        if not self.schema:
            into = found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            into.partitionBy(*DAY.partitions).parquet(self.path(DAY))
            return
        # Inserts into tables follow the session only; nothing else of this package overwrites.
        before = self.spark.conf.get(_OVERWRITE)
        self.spark.conf.set(_OVERWRITE, "dynamic")
        try:
            found.write.insertInto(f"{self._quoted}.{DAY.name}", overwrite=True)
        finally:
            self.spark.conf.set(_OVERWRITE, before)

    def days(self) -> DataFrame:
        """Totals of each check on each refreshed day."""
        return self.read(DAY).where("run_count > 0")

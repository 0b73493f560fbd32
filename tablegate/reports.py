"""Monitoring reports over the log tables.

``as_of`` stands for today and defaults to the current date. Logs are partitioned by date, so
reports on a period also filter on the partition column where the frame has one.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _since(as_of: date | None, days: int) -> Column:
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_sub(today, days)


def _recent(log: DataFrame, time_col: str, first_day: Column) -> DataFrame:
    if "check_date" in log.columns:
        log = log.where(F.col("check_date") >= first_day)
    return log.where(F.col(time_col) >= first_day.cast(log.schema[time_col].dataType))


# The columns of the six reports, which their readers know by name.


def recent_runs(runs: DataFrame, as_of: date | None = None, days: int = 7) -> DataFrame:
    """Runs of the last days with their duration in whole seconds, newest first."""
    return (
        _recent(runs, "started_at", _since(as_of, days))
        .orderBy(F.col("started_at").desc())
        .select(
            F.to_date("started_at").alias("run_date"),
            "tier_name",
            "status",
            "total_checks",
            "passed_checks",
            "failed_checks",
            "warned_checks",
            "pipeline_run_id",
            "batch_id",
            F.timestamp_diff("SECOND", F.col("started_at"), F.col("completed_at")).alias("duration_sec"),
        )
    )


def open_issues(checks: DataFrame, as_of: date | None = None, days: int = 7) -> DataFrame:
    """Failed and warned checks of the last days, newest first, then by severity downwards."""
    return (
        _recent(checks, "checked_at", _since(as_of, days))
        .where(F.col("status").isin("FAIL", "WARN"))
        .orderBy(F.col("checked_at").desc(), F.col("severity").desc())
        .select(
            "checked_at",
            "tier_name",
            "table_name",
            "check_name",
            "status",
            "severity",
            "check_description",
            "failure_count",
            "expected_value",
            "actual_value",
            F.round("variance_pct", 2).alias("variance_pct"),
            "failure_sample",
            "execution_ms",
        )
    )


def pass_rate_trend(checks: DataFrame, as_of: date | None = None, days: int = 30) -> DataFrame:
    """Checks and share of passed checks per day and tier."""
    period = _recent(checks, "checked_at", _since(as_of, days)).withColumn("_day", F.to_date("checked_at"))
    passed = F.count_if(F.col("status") == "PASS")
    return (
        period.groupBy(F.col("_day").alias("check_date"), "tier_name")
        .agg(
            F.count("*").alias("total"),
            passed.alias("passed"),
            F.count_if(F.col("status") == "FAIL").alias("failed"),
            F.count_if(F.col("status") == "WARN").alias("warned"),
            F.round((passed * 100).cast("double") / F.count("*"), 1).alias("pass_rate_pct"),
        )
        .orderBy(F.col("check_date").desc(), "tier_name")
    )


def recon_drift(snapshots: DataFrame) -> DataFrame:
    """All source reconciliation results, newest first."""
    return snapshots.orderBy(F.col("snapshot_date").desc(), "table_name", "metric_name").select(
        "snapshot_date",
        "table_name",
        "metric_name",
        "source_value",
        "silver_value",
        F.round("variance_pct", 4).alias("variance_pct"),
        "within_threshold",
        "threshold_pct",
    )


def slowest_checks(
    checks: DataFrame, as_of: date | None = None, days: int = 30, top: int = 20
) -> DataFrame:
    """The checks with the highest average run time; equal averages in order of name."""
    names = ["check_name", "table_name", "tier_name"]
    return (
        _recent(checks, "checked_at", _since(as_of, days))
        .groupBy(*names)
        .agg(
            F.round(F.avg("execution_ms"), 0).alias("avg_ms"),
            F.max("execution_ms").cast("bigint").alias("max_ms"),
            F.count("*").alias("run_count"),
        )
        .orderBy(F.col("avg_ms").desc(), *names)
        .limit(top)
    )


def day_totals(checks: DataFrame) -> DataFrame:
    """Totals of each check on each day; adding them up gives those of any period and any coarser group."""
    return checks.groupBy(F.to_date("checked_at").alias("check_date"), "tier_name", "table_name", "check_name").agg(
        F.count("*").alias("run_count"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.count_if(F.col("status") == "WARN").alias("warned"),
        F.count("execution_ms").alias("timed"),
        F.sum("execution_ms").alias("total_ms"),
        F.max("execution_ms").cast("bigint").alias("max_ms"),
    )


def pass_rate_trend_of_days(totals: DataFrame, as_of: date | None = None, days: int = 30) -> DataFrame:
    """``pass_rate_trend`` from totals of days."""
    period = totals.where(F.col("check_date") >= _since(as_of, days))
    total, passed = F.sum("run_count"), F.sum("passed")
    return (
        period.groupBy("check_date", "tier_name")
        .agg(
            total.alias("total"),
            passed.alias("passed"),
            F.sum("failed").alias("failed"),
            F.sum("warned").alias("warned"),
            F.round((passed * 100).cast("double") / total, 1).alias("pass_rate_pct"),
        )
        .orderBy(F.col("check_date").desc(), "tier_name")
    )


def slowest_checks_of_days(
    totals: DataFrame, as_of: date | None = None, days: int = 30, top: int = 20
) -> DataFrame:
    """``slowest_checks`` from totals of days."""
    names = ["check_name", "table_name", "tier_name"]
    return (
        totals.where(F.col("check_date") >= _since(as_of, days))
        .groupBy(*names)
        .agg(
            F.round(F.sum("total_ms") / F.nullif(F.sum("timed"), F.lit(0)), 0).alias("avg_ms"),
            F.max("max_ms").alias("max_ms"),
            F.sum("run_count").alias("run_count"),
        )
        .orderBy(F.col("avg_ms").desc(), *names)
        .limit(top)
    )


def check_drilldown(
    checks: DataFrame, check_name: str, since: date, top: int = 10
) -> DataFrame:
    """The latest log rows of one check."""
    return (
        _recent(checks, "checked_at", F.lit(since))
        .where(F.col("check_name") == F.lit(check_name))
        .orderBy(F.col("checked_at").desc())
        .limit(top)
        .select("checked_at", "batch_id", "status", "failure_count", "failure_sample", "sql_query")
    )

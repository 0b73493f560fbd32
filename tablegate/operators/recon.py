"""Reconciliation of curated aggregates with the source system."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.config import DEFAULT_RECON_THRESHOLD_PCT, HistorySpec, Metric, Status
from tablegate.functions.compare import off_zero_base, paired
from tablegate.sources.tables import Source, current


def source_recon(
    source: Source,
    source_table: str,
    curated: DataFrame,
    spec: HistorySpec,
    metrics: Sequence[Metric],
    threshold_pct: float = DEFAULT_RECON_THRESHOLD_PCT,
    strict_zero_base: bool = False,
) -> DataFrame:
    """A result row per metric: source aggregate over all rows, curated one over current rows.

    All metrics of a side are one aggregation. A NULL aggregate counts as 0, and a zero source
    value as no deviation unless ``strict_zero_base``.
    """
    names = [m.name for m in metrics]
    expected = source.aggregate(source_table, {m.name: m.source_expr for m in metrics})
    actual = current(curated, spec).agg(*[F.expr(m.curated_expr).alias(m.name) for m in metrics])
    rows = paired(_zeroed(expected, names), _zeroed(actual, names), names)
    within = F.abs("variance_pct") <= F.lit(float(threshold_pct))
    if strict_zero_base:
        within = within & ~off_zero_base()
    return rows.select(
        F.concat(F.lit("source_recon_"), "metric").alias("check_name"),
        F.col("metric").alias("metric_name"),
        "expected_value",
        "actual_value",
        "variance_value",
        "variance_pct",
        F.when(within, Status.PASS.value).otherwise(Status.WARN.value).alias("status"),
        within.alias("within_threshold"),
    )


def _zeroed(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    # A source may change the case of column names, so columns are taken by position.
    values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in frame.columns]
    return frame.select(*[v.alias(n) for v, n in zip(values, names)])


def recon_snapshot(
    recon: DataFrame,
    table_name: str,
    run_id: str | Column,
    snapshot_date: date | Column,
    threshold_pct: float = DEFAULT_RECON_THRESHOLD_PCT,
) -> DataFrame:
    """Trend rows for the snapshot log, one per row of ``source_recon``."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    day = snapshot_date if isinstance(snapshot_date, Column) else F.lit(snapshot_date)
    return recon.select(
        F.expr("uuid()").alias("snapshot_id"),
        run.alias("run_id"),
        day.cast("date").alias("snapshot_date"),
        F.lit(table_name).alias("table_name"),
        "metric_name",
        F.col("expected_value").alias("source_value"),
        F.col("actual_value").alias("silver_value"),
        "variance_value",
        "variance_pct",
        "within_threshold",
        F.lit(float(threshold_pct)).alias("threshold_pct"),
    )

"""The registered queries: one per operator, plus variants on other tables and keys.

Each takes (spark, sf_dir) and reads the whole tables. Columns are bigint, double, string,
date, boolean or decimal so that other engines return the same types.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate import gate, log, reports
from tablegate.config import ForeignKey, HistorySpec, Metric, TableSpec
from tablegate.functions.columns import COUNT
from tablegate.operators import completeness, history, recon, rules
from tablegate.plans import checks as plan
from tablegate.plans.lanes import find_hot_keys
from tablegate.plans.results import failure_sample, run_summary
from tablegate.sources.shared import shared_folder
from tablegate.sources.tables import FrameTables, batch_slice, current
from workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = date(2024, 1, 31)
DRILL_CHECK, DRILL_SINCE = "order.purchase", date(2024, 1, 15)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _text_time(df: DataFrame, *names: str) -> DataFrame:
    for n in names:
        df = df.withColumn(n, F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return df


def _big(df: DataFrame, *names: str) -> DataFrame:
    for n in names:
        df = df.withColumn(n, F.col(n).cast("bigint"))
    return df


# --- scans --------------------------------------------------------------------------------


@query
def scan_batch_slice(spark, sf):
    return batch_slice(t.bronze_order(spark, sf), "_batch_id", t.BATCH)


@query
def scan_current(spark, sf):
    return current(t.silver_order(spark, sf), t.ORDER).select(
        "order_id", "customer_id", "order_total", "effective_start_date", "effective_end_date"
    )


# --- completeness -------------------------------------------------------------------------


@query
def row_count_recon(spark, sf):
    return completeness.row_count_recon(t.bronze_order(spark, sf), t.silver_order(spark, sf), t.ORDER, t.BATCH)


@query
def key_coverage(spark, sf):
    return completeness.key_coverage(t.bronze_order(spark, sf), t.silver_order(spark, sf), t.ORDER, t.BATCH)


@query
def key_coverage_order_line(spark, sf):
    return completeness.key_coverage(
        t.bronze_order_line(spark, sf), t.silver_order_line(spark, sf), t.ORDER_LINE, t.BATCH
    )


@query
def numeric_sum_recon(spark, sf):
    return completeness.numeric_sum_recon(
        t.bronze_order(spark, sf), t.silver_order(spark, sf), t.ORDER, t.BATCH, t.REGISTRY["order"].sum_columns
    )


@query
def numeric_sum_recon_order_line(spark, sf):
    return completeness.numeric_sum_recon(
        t.bronze_order_line(spark, sf),
        t.silver_order_line(spark, sf),
        t.ORDER_LINE,
        t.BATCH,
        t.REGISTRY["order_line"].sum_columns,
    )


# --- history ------------------------------------------------------------------------------


@query
def dup_current(spark, sf):
    return history.duplicate_current(t.silver_order(spark, sf), t.ORDER)


@query
def dup_current_lineitem(spark, sf):
    """Repeated (order, line) pairs of the raw table, every row taken as current."""
    spec = HistorySpec(("l_orderkey", "l_linenumber"))
    rows = t.read(spark, sf, "lineitem").withColumn("is_current", F.lit(True))
    return _big(history.duplicate_current(rows, spec), "l_linenumber")


def _overlaps(df: DataFrame, spec: HistorySpec) -> DataFrame:
    return history.overlapping_ranges(df, spec, find_hot_keys(df, spec))


@query
def overlap_pairs(spark, sf):
    return _overlaps(t.silver_order(spark, sf), t.ORDER)


@query
def overlap_pairs_order_line(spark, sf):
    return _big(_overlaps(t.silver_order_line(spark, sf), t.ORDER_LINE), "line_number")


@query
def overlap_counts_event_spans(spark, sf):
    """A handful of keys that hold all rows: an event is a version that lasts some days, and a
    quarter of them end before they start."""
    e = t.read(spark, sf, "events")
    day = F.col("ts").cast("date")
    spans = e.select(
        "event_type",
        day.alias("effective_start_date"),
        F.date_add(day, (F.col("event_id") % 4).cast("int") - 1).alias("effective_end_date"),
    )
    spec = HistorySpec(("event_type",))
    counts = history.overlap_counts(spans, spec)
    return counts.withColumnRenamed(COUNT, "pairs")


@query
def overlap_counts_event_times(spark, sf):
    """The same by the second, so that hardly any two rows are equal."""
    e = t.read(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp"))
    length = F.make_dt_interval(hours=(F.col("event_id") % 7).cast("int") - 2)
    spans = e.select(
        "event_type", F.col("at").alias("effective_start_date"), (F.col("at") + length).alias("effective_end_date")
    )
    spec = HistorySpec(("event_type",))
    counts = history.overlap_counts(spans, spec)
    return counts.withColumnRenamed(COUNT, "pairs")


def _chain(df: DataFrame, spec: HistorySpec) -> DataFrame:
    return history.chain_continuity(df, spec)


@query
def chain_continuity(spark, sf):
    return _chain(t.silver_order(spark, sf), t.ORDER)


@query
def chain_continuity_customer(spark, sf):
    return _chain(t.silver_customer(spark, sf), t.CUSTOMER)


@query
def null_start(spark, sf):
    return history.null_start(t.silver_order(spark, sf), t.ORDER)


@query
def null_end_closed(spark, sf):
    return history.null_end_on_closed(t.silver_order(spark, sf), t.ORDER)


@query
def start_lte_end(spark, sf):
    return history.start_after_end(t.silver_order(spark, sf), t.ORDER)


@query
def orphan_keys(spark, sf):
    return history.orphan_keys(t.silver_order(spark, sf), t.ORDER)


# --- rules --------------------------------------------------------------------------------


@query
def required_fields(spark, sf):
    return rules.required_fields(t.silver_order(spark, sf), t.ORDER, t.REGISTRY["order"].required)


@query
def required_fields_customer(spark, sf):
    return rules.required_fields(t.silver_customer(spark, sf), t.CUSTOMER, t.REGISTRY["customer"].required)


@query
def numeric_range(spark, sf):
    bounds = t.REGISTRY["order"].ranges["order_total"]
    return rules.numeric_range(t.silver_order(spark, sf), t.ORDER, "order_total", *bounds)


@query
def numeric_ranges_order_line(spark, sf):
    found = rules.numeric_ranges(t.silver_order_line(spark, sf), t.ORDER_LINE, t.REGISTRY["order_line"].ranges)
    return _big(found, "line_number")


@query
def foreign_key(spark, sf):
    (fk,) = t.REGISTRY["order"].foreign_keys
    return rules.foreign_key(
        t.silver_order(spark, sf), t.silver_customer(spark, sf), t.ORDER, fk, t.CUSTOMER
    )


@query
def foreign_key_order_line(spark, sf):
    (fk,) = t.REGISTRY["order_line"].foreign_keys
    found = rules.foreign_key(
        t.silver_order_line(spark, sf), t.silver_order(spark, sf), t.ORDER_LINE, fk, t.ORDER
    )
    return _big(found, "line_number")


@query
def foreign_key_product(spark, sf):
    """References to a table that no registry entry describes."""
    fk = ForeignKey("product_id", "product", "product_id")
    lines, products = t.silver_order_line(spark, sf), t.product(spark, sf)
    return _big(rules.foreign_key(lines, products, t.ORDER_LINE, fk, HistorySpec(("product_id",))), "line_number")


@query
def rule_shipped_has_date(spark, sf):
    return rules.conditional_rule(t.silver_order(spark, sf), t.ORDER, t.SHIPPED_HAS_DATE)


@query
def rule_cancelled_total(spark, sf):
    return rules.conditional_rule(t.silver_order(spark, sf), t.ORDER, t.CANCELLED_TOTAL)


@query
def rule_corporate_name(spark, sf):
    return rules.conditional_rule(t.silver_customer(spark, sf), t.CUSTOMER, t.CORPORATE_NAME)


@query
def dup_business_key(spark, sf):
    return rules.duplicate_keys(t.silver_order(spark, sf), t.ORDER)


# --- source reconciliation ----------------------------------------------------------------


def _order_recon(spark, sf):
    spec = t.REGISTRY["order"]
    return recon.source_recon(
        t.source(spark, sf), spec.source_table, t.silver_order(spark, sf), t.ORDER, spec.metrics
    )


@query
def source_recon(spark, sf):
    return _order_recon(spark, sf).drop("metric_name")


@query
def source_recon_distinct(spark, sf):
    """A metric of the user's own: distinct keys and the share of large orders."""
    metrics = [
        Metric("entities", "COUNT(DISTINCT OrderID)", "COUNT(DISTINCT order_id)"),
        Metric(
            "large_orders",
            "SUM(CASE WHEN OrderTotal > 300000 THEN 1 ELSE 0 END)",
            "SUM(CASE WHEN order_total > 300000 THEN 1 ELSE 0 END)",
        ),
    ]
    rows = recon.source_recon(
        t.source(spark, sf), "dbo.SalesOrder", t.silver_order(spark, sf), t.ORDER, metrics, 5.0
    )
    return rows.drop("metric_name")


@query
def recon_snapshot(spark, sf):
    rows = recon.recon_snapshot(_order_recon(spark, sf), "order", "run-1", AS_OF)
    return rows.drop("snapshot_id")


# --- results ------------------------------------------------------------------------------

_RESULT = ("check_name", "status", "severity", "failure_count")


def _groups(spark, sf, *tiers: int) -> list[plan.Group]:
    tables, source = t.tables(spark, sf), t.source(spark, sf)
    made = {
        1: lambda spec: plan.completeness_groups(spec, tables, t.BATCH),
        2: lambda spec: plan.history_groups(spec, tables),
        3: lambda spec: plan.rule_groups(spec, tables, t.REGISTRY.__getitem__),
        4: lambda spec: plan.recon_groups(spec, tables, source, 1.0),
    }
    return [g for n in tiers for spec in t.REGISTRY for g in made[n](spec)]


def _results(spark, sf, *tiers: int) -> DataFrame:
    return plan.check_results(_groups(spark, sf, *tiers))


@query
def check_results_completeness(spark, sf):
    return _results(spark, sf, 1).select(*_RESULT, "expected_value", "actual_value", "variance_pct")


@query
def check_results_history(spark, sf):
    return _results(spark, sf, 2).select(*_RESULT)


@query
def check_results_rules(spark, sf):
    return _results(spark, sf, 3).select(*_RESULT)


@query
def check_results_more_rules(spark, sf):
    """Rules off by default or on other tables: duplicate keys, and a parent that is not registered."""
    made = t.tables(spark, sf)
    tables = FrameTables(made.raw_frames, {**made.curated_frames, "product": t.product(spark, sf)})
    order = TableSpec("order", t.ORDER, duplicate_rule=True)
    line = TableSpec("order_line", t.ORDER_LINE, foreign_keys=(ForeignKey("product_id", "product", "product_id"),))
    parents = t.REGISTRY.__getitem__
    groups = [g for spec in (order, line) for g in plan.rule_groups(spec, tables, parents)]
    return plan.check_results(groups).select(*_RESULT)


@query
def check_results_recon(spark, sf):
    return _results(spark, sf, 4).select(
        "check_name", "status", "severity", "expected_value", "actual_value", "variance_pct"
    )


def _failure_sample(spark, sf):
    """Samples of the history and rule checks of the order table that failed."""
    tables = t.tables(spark, sf)
    spec = t.REGISTRY["order"]
    groups = plan.history_groups(spec, tables) + plan.rule_groups(spec, tables, t.REGISTRY.__getitem__)
    return failure_sample(plan.offenders(groups))


QUERIES["failure_sample"] = _failure_sample


def _run_summary(spark, sf):
    rows = run_summary(_results(spark, sf, 1, 2, 3, 4), ("tier",))
    return _big(rows, "tier")


QUERIES["run_summary"] = _run_summary


@query
def pipeline_gate(spark, sf):
    return gate.pipeline_gate(run_summary(_results(spark, sf, 1, 2, 3, 4), ("tier",)))


@query
def pipeline_gate_by_run(spark, sf):
    """The gate over the raw run log: a verdict per pipeline run, with reruns and runs still open."""
    opened, ended = t.run_events(spark, sf)
    later = F.expr("started_at + INTERVAL 1 DAY")
    again = ended.where("status <> 'PASS' AND tier = 1").withColumns(
        {"run_id": F.concat("run_id", F.lit("-again")), "started_at": later, "completed_at": later, "status": F.lit("PASS")}
    )
    still = ended.where("warned_checks = 0 AND tier = 2").withColumns(
        {
            "run_id": F.concat("run_id", F.lit("-open")),
            "started_at": later,
            "completed_at": F.lit(None).cast("timestamp"),
            "status": F.lit("RUNNING"),
        }
    )
    columns = ["run_id", "pipeline_run_id", "tier", "started_at", "completed_at", "status"]
    events = reduce(DataFrame.unionByName, [x.select(*columns) for x in (opened, ended, again, still)])
    return gate.pipeline_gate(events, ("pipeline_run_id",))


# --- log ----------------------------------------------------------------------------------


@query
def check_log_roundtrip(spark, sf):
    """Append the check log in two parts and read it back."""
    store = log.ValidationLog(spark, shared_folder(spark)).ensure()
    rows = t.check_log(spark, sf).drop("check_date")
    store.write(log.CHECK, rows.where("status = 'PASS'"))
    store.write(log.CHECK, rows.where("status <> 'PASS'"))
    return _big(_text_time(store.checks(), "checked_at"), "tier")


@query
def check_log_published(spark, sf):
    """The check log as readers see it while runs that passed have not been closed yet."""
    store = log.ValidationLog(spark, shared_folder(spark)).ensure()
    opened, ended = t.run_events(spark, sf)
    store.write(log.RUN, opened)
    store.write(log.CHECK, t.check_log(spark, sf).drop("check_date"))
    store.write(log.RUN, ended.where("status <> 'PASS'"))
    return _text_time(store.checks(), "checked_at").select("check_id", "run_id", "checked_at", "check_name", "status")


@query
def run_upsert(spark, sf):
    """Rows of opened runs replaced by those of ended ones."""
    opened, ended = t.run_events(spark, sf)
    done = ended.where(F.col("status") != "PASS")
    rows = log.upsert_latest(opened, done, "run_id")
    counts = ("total_checks", "passed_checks", "failed_checks", "warned_checks")
    rows = _big(_text_time(rows, "started_at", "completed_at"), "tier", *counts)
    return rows.drop("error_message")


@query
def run_latest(spark, sf):
    """The same by appending both kinds of rows and keeping the last one per run."""
    opened, ended = t.run_events(spark, sf)
    rows = log.latest_runs(opened.unionByName(ended))
    return _big(_text_time(rows, "completed_at"), "total_checks").select(
        "run_id", "status", "completed_at", "total_checks"
    )


# --- reports ------------------------------------------------------------------------------


@query
def recent_runs(spark, sf):
    _, ended = t.run_events(spark, sf)
    counts = ("total_checks", "passed_checks", "failed_checks", "warned_checks")
    return _big(reports.recent_runs(ended, AS_OF), *counts)


@query
def open_issues(spark, sf):
    return _text_time(reports.open_issues(t.check_log(spark, sf), AS_OF), "checked_at")


@query
def pass_rate_trend(spark, sf):
    return reports.pass_rate_trend(t.check_log(spark, sf), AS_OF)


def _day_totals(spark, sf):
    """Totals of the days of the log: first of most checks, then with all of them, late ones included."""
    store = log.ValidationLog(spark, shared_folder(spark)).ensure()
    rows = t.check_log(spark, sf).drop("check_date")
    store.write(log.CHECK, rows.where("status <> 'FAIL'"))
    first, last = rows.agg(F.to_date(F.min("checked_at")), F.to_date(F.max("checked_at"))).first()
    store.refresh_days(first, last)
    store.write(log.CHECK, rows.where("status = 'FAIL'"))
    store.refresh_days(first, last)
    return store.days()


@query
def pass_rate_trend_of_days(spark, sf):
    return reports.pass_rate_trend_of_days(_day_totals(spark, sf), AS_OF)


@query
def slowest_checks_of_days(spark, sf):
    return reports.slowest_checks_of_days(_day_totals(spark, sf), AS_OF)


@query
def recon_drift(spark, sf):
    return reports.recon_drift(t.snapshots(spark, sf))


@query
def slowest_checks(spark, sf):
    return reports.slowest_checks(t.check_log(spark, sf), AS_OF)


@query
def check_drilldown(spark, sf):
    rows = reports.check_drilldown(t.check_log(spark, sf), DRILL_CHECK, DRILL_SINCE)
    return _text_time(rows, "checked_at")

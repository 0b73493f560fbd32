"""Log tables, summaries, gate and reports on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablegate import log, reports
from tablegate.config import ConfigError
from tablegate.functions.columns import COUNT
from tablegate.gate import PipelineBlocked, enforce_gate, pipeline_gate
from tablegate.plans.results import failure_sample, overall, run_summary
from tablegate.sources.shared import shared_folder


def test_schema_and_tables_are_created_once(spark, tmp_path):
    store = log.ValidationLog(spark, str(tmp_path), "validation_once")
    store.ensure().ensure()
    names = {r["tableName"] for r in spark.sql("SHOW TABLES IN validation_once").collect()}
    assert names == {x.name for x in log.LOG_TABLES}
    assert len(spark.table("validation_once.validation_run").columns) == 16
    assert len(spark.table("validation_once.validation_check").columns) == 22
    assert len(spark.table("validation_once.validation_source_recon_snapshot").columns) == 11


@pytest.mark.parametrize("schema", [None, "validation_fresh"])
def test_reports_of_a_fresh_log_are_empty(spark, tmp_path, schema):
    store = log.ValidationLog(spark, str(tmp_path / "it's new"), schema).ensure().ensure()
    day = date(2024, 1, 1)
    frames = [
        reports.recent_runs(store.runs(), day),
        reports.open_issues(store.checks(), day),
        reports.pass_rate_trend(store.checks(), day),
        reports.recon_drift(store.snapshots()),
        reports.slowest_checks(store.checks(), day),
        reports.check_drilldown(store.checks(), "a", day),
    ]
    assert [f.count() for f in frames] == [0] * 6


def test_the_last_run_decides(spark):
    day = lambda d: datetime(2024, 1, d)
    rows = [
        ("p", 1, "a", day(1), None, "RUNNING"),
        ("p", 1, "a", day(1), day(1), "FAIL"),
        ("p", 1, "b", day(2), day(2), "PASS"),
        ("p", 2, "c", day(3), day(3), "PASS"),
        ("p", 2, "d", day(4), None, "RUNNING"),
        ("q", 1, "e", day(5), day(5), "PASS"),
        ("q", 2, "f", day(5), day(5), "FAIL"),
        ("q", 2, "g", day(6), day(6), "PASS"),
    ]
    columns = "pipeline_run_id string, tier int, run_id string, started_at timestamp, completed_at timestamp, status string"
    runs = spark.createDataFrame(rows, columns)
    found = {r["pipeline_run_id"]: r for r in pipeline_gate(runs, ("pipeline_run_id",)).collect()}
    assert (found["p"]["tier1_pass"], found["p"]["tier2_pass"], found["p"]["overall_pass"]) == (True, False, False)
    assert found["q"]["overall_pass"] and found["q"]["tier4_pass"] and not found["q"]["tier3_pass"]
    enforce_gate(runs)
    with pytest.raises(PipelineBlocked, match="tier2_pass"):
        enforce_gate(runs.where("run_id <> 'g'"))


def snapshot(spark, day):
    row = ("s", "r", day, "t", "m", 1.0, 1.0, 0.0, 0.0, True, 1.0)
    return spark.createDataFrame([row], " ".join(log.SNAPSHOT_COLUMNS.split()))


@pytest.mark.parametrize("schema", [None, "validation_append"])
def test_snapshots_are_appended(spark, tmp_path, schema):
    store = log.ValidationLog(spark, str(tmp_path), schema).ensure()
    store.write(log.SNAPSHOT, snapshot(spark, date(2024, 1, 1)))
    store.write(log.SNAPSHOT, snapshot(spark, date(2024, 1, 2)))
    rows = store.snapshots().orderBy("snapshot_date").collect()
    assert [r["snapshot_date"].day for r in rows] == [1, 2] and rows[0]["threshold_pct"] == 1.0


def test_a_log_needs_a_place(spark):
    with pytest.raises(ConfigError):
        log.ValidationLog(spark)


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir") + "/tablegate/")


def test_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([("a", "RUNNING"), ("b", "RUNNING")], "run_id string, status string")
    updates = spark.createDataFrame([("PASS", "b"), ("FAIL", "c")], "status string, run_id string")
    rows = log.upsert_latest(target, updates, "run_id").collect()
    assert {(r["run_id"], r["status"]) for r in rows} == {("a", "RUNNING"), ("b", "PASS"), ("c", "FAIL")}


def test_last_run_row_wins(spark):
    at = datetime(2024, 1, 1)
    rows = [("a", "RUNNING", None), ("a", "PASS", at), ("b", "RUNNING", None), ("c", "ERROR", at)]
    events = spark.createDataFrame(rows, "run_id string, status string, completed_at timestamp")
    found = {r["run_id"]: r["status"] for r in log.latest_runs(events).collect()}
    assert found == {"a": "PASS", "b": "RUNNING", "c": "ERROR"}


RUN_EVENT = "run_id string, pipeline_run_id string, batch_id string, table_name string, tier int, started_at timestamp, completed_at timestamp, status string"


def test_open_and_replaced_runs_are_not_published(spark):
    at = lambda d: datetime(2024, 1, d)
    rows = [
        ("killed", "p", "B", "ALL", 1, at(1), None, "RUNNING"),
        ("broken", "p", "B", "ALL", 1, at(2), None, "RUNNING"),
        ("broken", "p", "B", "ALL", 1, at(2), at(2), "ERROR"),
        ("failed", "p", "B", "ALL", 1, at(3), at(3), "FAIL"),
        ("again", "p", "B", "ALL", 1, at(4), at(4), "PASS"),
        # The last attempt is an error, and these two have nothing that replaces them.
        ("last", "p", "B", "ALL", 1, at(5), at(5), "ERROR"),
        ("other tier", "p", "B", "ALL", 2, at(1), at(1), "ERROR"),
        ("no pipeline", None, None, None, 1, at(1), at(1), "ERROR"),
        ("no pipeline again", None, None, None, 1, at(2), at(2), "PASS"),
    ]
    found = log.unpublished_runs(spark.createDataFrame(rows, RUN_EVENT)).collect()
    assert sorted(r["run_id"] for r in found) == ["broken", "killed"]
    assert log.unpublished_runs(spark.createDataFrame([], RUN_EVENT)).count() == 0


def checked(spark, *rows):
    """Rows (run_id, day, name, status, ms) of the check log."""
    made = spark.createDataFrame(list(rows), "run_id string, checked_at timestamp, check_name string, status string, ms long")
    fixed = {"check_id": "c", "tier_name": "Completeness", "table_name": "t", "check_category": "x", "severity": "y"}
    made = made.withColumns({c: F.lit(v) for c, v in fixed.items()}).withColumn("tier", F.lit(1).cast("tinyint"))
    made = made.withColumnRenamed("ms", "execution_ms")
    schema = spark.createDataFrame([], " ".join(log.CHECK_COLUMNS.split())).schema
    absent = [f for f in schema if f.name not in made.columns]
    return made.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent]).select(schema.names)


@pytest.mark.parametrize("schema", [None, "validation_days"])
def test_reports_of_days_equal_reports_of_checks(spark, tmp_path, schema):
    store = log.ValidationLog(spark, str(tmp_path), schema).ensure()
    at = lambda d, h=0: datetime(2024, 1, d, h)
    trend = lambda f: [tuple(r) for r in f.collect()]
    store.write(log.CHECK, checked(spark, ("r", at(1), "a", "PASS", 10), ("r", at(2, 23), "a", "FAIL", 15), ("r", at(2), "b", "WARN", None)))
    store.refresh_days(date(2024, 1, 1), date(2024, 1, 3))
    store.refresh_days(date(2024, 1, 1), date(2024, 1, 3))
    # Late rows of an old day and rows of a new one; a day that is not refreshed stays as it was.
    store.write(log.CHECK, checked(spark, ("s", at(1, 5), "a", "FAIL", 21), ("s", at(3), "b", "PASS", None)))
    store.refresh_days(date(2024, 1, 1), date(2024, 1, 1))
    assert {(r["check_date"].day, r["check_name"], r["run_count"]) for r in store.days().collect()} == {(1, "a", 2), (2, "a", 1), (2, "b", 1)}
    store.refresh_days(date(2024, 1, 3), date(2024, 1, 3))
    for as_of, days in ((date(2024, 1, 31), 30), (date(2024, 1, 31), 29), (date(2024, 1, 3), 0)):
        assert trend(reports.pass_rate_trend_of_days(store.days(), as_of, days)) == trend(reports.pass_rate_trend(store.checks(), as_of, days))
        assert trend(reports.slowest_checks_of_days(store.days(), as_of, days)) == trend(reports.slowest_checks(store.checks(), as_of, days))
    # A run that turns out to be open takes its rows along, and the day is empty then.
    opened = ("s", "p", "B", "ALL", 1, "x", at(1), "RUNNING")
    columns = "run_id string, pipeline_run_id string, batch_id string, table_name string, tier tinyint, tier_name string, started_at timestamp, status string"
    event = spark.createDataFrame([opened], columns)
    schema_of_runs = spark.createDataFrame([], " ".join(log.RUN_COLUMNS.split())).schema
    event = event.select(*[F.col(f.name) if f.name in event.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema_of_runs])
    store.write(log.RUN, event)
    store.refresh_days(date(2024, 1, 1), date(2024, 1, 3))
    assert {(r["check_date"].day, r["check_name"], r["run_count"]) for r in store.days().collect()} == {(1, "a", 1), (2, "a", 1), (2, "b", 1)}


def test_summary_prefers_fail_over_warn(spark):
    rows = [("a", "PASS"), ("a", "WARN"), ("b", "WARN"), ("b", "FAIL"), ("c", "PASS")]
    found = run_summary(spark.createDataFrame(rows, "run_id string, status string")).collect()
    assert {r["run_id"]: r["status"] for r in found} == {"a": "WARN", "b": "FAIL", "c": "PASS"}
    assert overall([]).value == "PASS" and overall(["WARN", "PASS"]).value == "WARN"


def gate_of(spark, *rows):
    return pipeline_gate(spark.createDataFrame(list(rows), "tier int, status string")).first()


def test_gate(spark):
    verdict = gate_of(spark, (1, "PASS"), (2, "PASS"), (3, "WARN"))
    assert verdict.asDict() == {
        "tier1_pass": True,
        "tier2_pass": True,
        "tier3_pass": False,
        "tier4_pass": True,
        "overall_pass": True,
    }
    for status in ("WARN", "FAIL", "RUNNING", "ERROR"):
        assert not gate_of(spark, (1, "PASS"), (2, status))["overall_pass"]
    assert not gate_of(spark, (1, "PASS"))["overall_pass"]
    assert gate_of(spark, (4, "WARN"))["tier4_pass"] is False
    with pytest.raises(PipelineBlocked, match="tier2_pass"):
        enforce_gate(spark.createDataFrame([(1, "PASS"), (2, "FAIL")], "tier int, status string"))


def test_sample_takes_first_keys_and_repeats(spark):
    rows = [("a", f'{{"k":{i}}}', 1) for i in range(100, 130)] + [("b", '{"k":1}', 3), ("b", '{"k":0}', 1)]
    tagged = spark.createDataFrame(rows, f"check_name string, key_json string, {COUNT} bigint")
    found = dict(failure_sample(tagged).collect())
    assert found["a"] == "[" + ",".join(f'{{"k":{i}}}' for i in range(100, 110)) + "]"
    assert found["b"] == '[{"k":0},{"k":1},{"k":1},{"k":1}]'


def test_duration_is_whole_elapsed_seconds(spark):
    start = datetime(2024, 1, 30, 10, 0, 0)
    rows = [("r", start, datetime(2024, 1, 30, 10, 1, 1, 900000)), ("old", datetime(2024, 1, 1), None)]
    runs = spark.createDataFrame(rows, "pipeline_run_id string, started_at timestamp, completed_at timestamp")
    empty = ("tier_name", "status", "total_checks", "passed_checks", "failed_checks", "warned_checks", "batch_id")
    for c in empty:
        runs = runs.selectExpr("*", f"cast(null as string) as {c}")
    found = reports.recent_runs(runs, date(2024, 1, 31)).collect()
    assert [(r["pipeline_run_id"], r["duration_sec"], r["run_date"]) for r in found] == [("r", 61, date(2024, 1, 30))]


def test_reports_prune_log_partitions(spark, tmp_path):
    from workload import tables as t

    store = log.ValidationLog(spark, str(tmp_path))
    store.write(log.CHECK, t.check_log(spark, "/root/testdata/sf0.001").drop("check_date"))
    issues = reports.open_issues(store.checks(), date(2024, 1, 31))
    text = issues._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(check_date" in text
    assert issues.count() == 60
    rows = issues.select("checked_at", "severity").collect()
    assert rows == sorted(rows, key=lambda r: (r["checked_at"], r["severity"]), reverse=True)

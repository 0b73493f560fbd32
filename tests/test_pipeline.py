"""Whole runs: order of tiers, gate, log contents, and checks that fail on their own."""

from __future__ import annotations

import json

import pytest

from tablegate import log
from tablegate.config import COMPLETENESS, HISTORY, RECON, RULES, ConfigError, ForeignKey, Registry, Status
from tablegate.gate import PipelineBlocked
from tablegate.pipeline import Pipeline, RunOptions
from tablegate.sources.tables import FrameTables
from workload import tables as t

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root, out = tmp_path_factory.mktemp("tables"), {}
    for clean in (False, True):
        made, parts = t.tables(spark, SF, clean), []
        for layer, frames in (("raw", made.raw_frames), ("curated", made.curated_frames)):
            part = {}
            for name, frame in frames.items():
                path = f"{root}/{clean}_{layer}_{name}"
                frame.coalesce(1).write.parquet(path)
                part[name] = spark.read.parquet(path)
            parts.append(part)
        out[clean] = FrameTables(*parts)
    return out


def pipeline(spark, tables, path, registry=t.REGISTRY) -> Pipeline:
    return Pipeline(spark, registry, tables, log.ValidationLog(spark, str(path)), t.source(spark, SF))


def clean_registry():
    """Without the sum that the curated layer changes on purpose."""
    return t.REGISTRY.override("order", sum_columns=("tax_amount",))


def test_clean_run(spark, stored, tmp_path):
    p = pipeline(spark, stored[True], tmp_path, clean_registry())
    done = p.run(RunOptions("B1", "run-7", run_recon=True, run_by="job", env="test"))
    assert done.overall_pass and done.passed(RULES) and not done.passed(RECON)
    runs = {r["tier"]: r for r in p.log.runs().collect()}
    assert [runs[n]["status"] for n in (1, 2, 3, 4)] == ["PASS", "PASS", "PASS", "WARN"]
    assert [runs[n]["total_checks"] for n in (1, 2, 3, 4)] == [9, 21, 22, 4]
    assert runs[2]["failed_checks"] == 0 and runs[2]["table_name"] == "ALL" and runs[2]["env"] == "test"
    assert p.log.read(log.RUN).count() == 8
    assert p.log.checks().count() == 56
    assert p.log.snapshots().count() == 4
    row = p.log.snapshots().where("metric_name = 'sum_order_total'").first()
    assert not row["within_threshold"] and row["source_value"] > row["silver_value"]


def test_defects_block_the_run_and_are_logged(spark, stored, tmp_path):
    p = pipeline(spark, stored[False], tmp_path)
    with pytest.raises(PipelineBlocked, match="tier 1"):
        p.run(RunOptions("B1", "run-8"))
    assert {r["tier"] for r in p.log.runs().collect()} == {1}
    outcome = p.run_tier(HISTORY, RunOptions("B1", "run-8"))
    assert outcome.status is Status.FAIL and len(outcome.rows) == 21
    rows = {r["check_name"]: r for r in p.log.checks().where("tier = 2").collect()}
    overlap = rows["order.scd2_no_overlapping_dates"]
    assert (overlap["status"], overlap["severity"], overlap["failure_count"]) == ("FAIL", "BLOCKING", 36)
    assert len(json.loads(overlap["failure_sample"])) == 10
    clean = rows["customer.scd2_start_lte_end"]
    assert (clean["status"], clean["failure_count"], clean["failure_sample"]) == ("PASS", 0, None)
    assert rows["order.scd2_no_orphan_keys"]["sql_query"].startswith("SELECT order_id FROM")
    rules = p.run_tier(RULES, RunOptions("B1"))
    samples = {r.check.full_name: r.failure_sample for r in rules.rows}
    assert rules.status is Status.WARN
    keys = json.loads(samples["order_line.range_quantity"])[0]
    assert set(keys) == {"order_id", "line_number", "quantity"}
    assert set(json.loads(samples["order.fk_customer_id_to_customer"])[0]) == {"order_id", "customer_id"}


class Killed(BaseException):
    """Ends a run without letting it close."""


class Stops(log.ValidationLog):
    """Does the append that ``stop`` picks, then fails."""

    def __init__(self, spark, path, stop, error):
        super().__init__(spark, path)
        self.stop, self.error, self.writes = stop, error, []

    def write(self, table, df):
        super().write(table, df)
        self.writes.append(table)
        if self.stop(self.writes):
            raise self.error


def test_a_killed_attempt_is_not_counted_twice(spark, stored, tmp_path):
    options = RunOptions("B1", "run-9", tables="customer")
    p = pipeline(spark, stored[True], tmp_path)
    p.log = Stops(spark, str(tmp_path), lambda done: done[-1] is log.CHECK, Killed()).ensure()
    p.log.writes.clear()
    with pytest.raises(Killed):
        p.run_tier(COMPLETENESS, options)
    assert p.log.read(log.CHECK).count() == 2 and p.log.checks().count() == 0
    p.log = log.ValidationLog(spark, str(tmp_path))
    outcome = p.run_tier(COMPLETENESS, options)
    assert p.log.read(log.CHECK).count() == 4
    rows = p.log.checks().collect()
    assert len(rows) == 2 and {r["run_id"] for r in rows} == {outcome.run_id}


def test_checks_are_appended_once_if_a_later_append_fails(spark, stored, tmp_path):
    options = RunOptions("B1", "run-9", run_recon=True)
    p = pipeline(spark, stored[True], tmp_path)
    p.log = Stops(spark, str(tmp_path), lambda done: done[-1] is log.SNAPSHOT, RuntimeError("lost")).ensure()
    with pytest.raises(RuntimeError, match="lost"):
        p.run_tier(RECON, options)
    assert p.log.read(log.CHECK).count() == 4 and p.log.runs().first()["status"] == "ERROR"
    p.log = log.ValidationLog(spark, str(tmp_path))
    outcome = p.run_tier(RECON, options)
    for rows in (p.log.checks().collect(), p.log.snapshots().collect()):
        assert len(rows) == 4 and {r["run_id"] for r in rows} == {outcome.run_id}


def test_one_table(spark, stored, tmp_path):
    p = pipeline(spark, stored[True], tmp_path)
    outcome = p.run_tier(COMPLETENESS, RunOptions("B1", tables="customer"))
    assert [r.check.full_name for r in outcome.rows] == [
        "customer.row_count_bronze_vs_silver",
        "customer.key_coverage_bronze_to_silver",
    ]
    assert p.log.runs().first()["table_name"] == "customer"
    with pytest.raises(ConfigError):
        p.run(RunOptions("B1", tables="nothing"))


def test_a_bad_check_fails_alone(spark, stored, tmp_path):
    registry = t.REGISTRY.override(
        "customer",
        required=("customer_id", "no_such_column"),
        rules={"good": "is_current AND customer_id < 0", "bad_syntax": "is_current AND (", "breaks": "1 / 0 > 1"},
    )
    outcome = pipeline(spark, stored[True], tmp_path, registry).run_tier(RULES, RunOptions(tables="customer"))
    by_name = {r.check.name: r for r in outcome.rows}
    assert by_name["required_field_customer_id"].status == "PASS"
    assert by_name["rule_good"].status == "PASS"
    for name in ("required_field_no_such_column", "rule_bad_syntax", "rule_breaks"):
        assert by_name[name].status == "FAIL" and by_name[name].error
    assert outcome.status is Status.FAIL


def test_a_missing_table_fails_its_own_checks(spark, stored, tmp_path):
    only_customer = FrameTables(stored[True].raw_frames, {"customer": stored[True].curated("customer")})
    p = pipeline(spark, only_customer, tmp_path)
    outcome = p.run_tier(HISTORY, RunOptions("B1"))
    assert outcome.status is Status.FAIL and len(outcome.rows) == 21
    assert {r.check.table for r in outcome.rows if r.error} == {"order", "order_line"}
    assert all(r.status == "PASS" for r in outcome.rows if r.check.table == "customer")
    assert p.log.runs().first()["status"] == "FAIL"
    assert p.log.checks().where("sql_query LIKE 'ERROR:%'").count() == 14


def test_errors_stay_with_their_checks(spark, stored, tmp_path):
    """A missing parent, start column or table fails the checks that need it; the run goes on."""
    made = stored[True]
    curated = {**made.curated_frames, "order": made.curated("order").drop("effective_start_date")}
    del curated["customer"]
    p = pipeline(spark, FrameTables(made.raw_frames, curated), tmp_path)
    rules = p.run_tier(RULES, RunOptions("B1"))
    failed = {r.check.full_name for r in rules.rows if r.error}
    assert "order.fk_customer_id_to_customer" in failed and "order.required_field_status" not in failed
    assert {n for n in failed if not n.startswith("customer.")} == {"order.fk_customer_id_to_customer"}
    history = p.run_tier(HISTORY, RunOptions("B1", tables=["order"]))
    by_name = {r.check.name: r for r in history.rows}
    assert by_name["scd2_no_orphan_keys"].status == "PASS" and by_name["scd2_no_duplicate_current"].status == "PASS"
    assert by_name["scd2_no_null_end_on_closed"].status == "PASS"
    assert all(by_name[n].error for n in ("scd2_no_null_effective_start", "scd2_chain_continuity"))
    parents = t.REGISTRY.override("order", foreign_keys=(ForeignKey("customer_id", "nowhere", "id"),))
    rules = pipeline(spark, made, tmp_path / "b", parents).run_tier(RULES, RunOptions("B1", tables="order"))
    assert [r.check.name for r in rules.rows if r.error] == ["fk_customer_id_to_nowhere"]


def test_tables_from_a_generator_are_checked_in_every_tier(spark, stored, tmp_path):
    p = pipeline(spark, stored[False], tmp_path)
    with pytest.raises(PipelineBlocked, match="tier 1"):
        p.run(RunOptions("B1", tables=(n for n in ["order"])))
    assert p.log.runs().first()["table_name"] == "order"
    outcome = p.run_tier(HISTORY, RunOptions("B1", tables=(n for n in ["order"])))
    assert len(outcome.rows) == 7 and outcome.status is Status.FAIL


def test_nothing_checked_does_not_pass(spark, stored, tmp_path):
    p = pipeline(spark, stored[True], tmp_path, Registry([]))
    with pytest.raises(PipelineBlocked):
        p.run(RunOptions("B1"))

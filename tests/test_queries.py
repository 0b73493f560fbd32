"""Every registered query against its SQL, and the known numbers of defects."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from tablegate.plans import checks as plan
from workload import oracle
from workload import tables as t
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, text = compare(spark, con, SF, name)
    assert ok, text


# Offending rows at the smallest size, computed before any of this code was written.
EXPECTED = {
    "order.scd2_no_duplicate_current": 14,
    "order.scd2_no_overlapping_dates": 36,
    "order.scd2_chain_continuity": 11,
    "order.scd2_no_null_effective_start": 13,
    "order.scd2_no_null_end_on_closed": 3,
    "order.scd2_start_lte_end": 3,
    "order.scd2_no_orphan_keys": 10,
    "order.key_coverage_bronze_to_silver": 4,
    "order_line.key_coverage_bronze_to_silver": 2,
    "order.row_count_bronze_vs_silver": 1,
    "order.required_field_customer_id": 10,
    "customer.required_field_email": 2,
    "order.range_order_total": 9,
    "order_line.range_quantity": 63,
    "order.fk_customer_id_to_customer": 29,
    "order_line.fk_order_id_to_order": 67,
    "order.rule_shipped_order_must_have_ship_date": 7,
    "order.rule_cancelled_order_total_must_be_zero_or_negative": 46,
    "customer.rule_corporate_account_must_have_company_name": 12,
}


def all_groups(spark, clean: bool):
    tables = t.tables(spark, SF, clean)
    source = t.source(spark, SF)
    for spec in t.REGISTRY:
        yield from plan.completeness_groups(spec, tables, t.BATCH)
        yield from plan.history_groups(spec, tables)
        yield from plan.rule_groups(spec, tables, t.REGISTRY.__getitem__)
        yield from plan.recon_groups(spec, tables, source, 1.0)


def test_full_run_finds_the_planted_defects(spark):
    rows = plan.check_results(list(all_groups(spark, False))).collect()
    assert len(rows) == 57
    found = {r["check_name"]: r["failure_count"] for r in rows}
    assert {k: found[k] for k in EXPECTED} == EXPECTED


def test_clean_tables_pass(spark):
    rows = plan.check_results(list(all_groups(spark, True))).collect()
    # Cancelled totals are zeroed on purpose, so sums of totals differ from raw and source.
    zeroed = {"order.numeric_sum_order_total", "order.source_recon_sum_order_total"}
    assert {r["check_name"] for r in rows if r["status"] != "PASS"} == zeroed


def test_entry_returns_all_history_checks(spark):
    assert entry.entry(spark).count() == 21

"""Hand-made edge rows for the checks that need no order of versions."""

from __future__ import annotations

from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablegate.config import ConfigError, ForeignKey, HistorySpec, Metric, Registry, TableSpec
from tablegate.functions.columns import COUNT, repeat_rows
from tablegate.operators import completeness, history, recon, rules
from tablegate.sources.tables import FrameSource, JdbcSource, batch_slice, current

SPEC = HistorySpec(("k",), is_current="cur", start="s", end="e", batch="b")
D = date(2024, 1, 1)


def counted(frame) -> Counter:
    return Counter(tuple(r) for r in frame.collect())


def _decimal(row):
    *rest, v = row
    return (*rest, None if v is None else Decimal(v))


def silver(spark, rows):
    rows = [_decimal(r) for r in rows]
    return spark.createDataFrame(rows, "k bigint, s date, e date, cur boolean, b string, v decimal(10,2)")


def row(k, cur=True, b="B1", v=None, s=D, e=None):
    return (k, s, e, cur, b, v)


def test_null_flag_is_neither_current_nor_closed(spark):
    df = silver(spark, [row(1, None), row(2, True), row(3, False, e=None)])
    assert counted(current(df, SPEC).select("k")) == {(2,): 1}
    assert counted(history.orphan_keys(df, SPEC)) == {(1,): 1, (3,): 1}
    assert counted(history.null_end_on_closed(df, SPEC)) == {(3,): 1}


def test_null_keys_form_one_group(spark):
    df = silver(spark, [row(None), row(None), row(1), row(1, False)])
    assert counted(history.duplicate_current(df, SPEC)) == {(None, 2): 1}
    assert counted(rules.duplicate_keys(df, SPEC)) == {(None, 2): 1}


def test_equal_start_and_end_is_in_order(spark):
    df = silver(spark, [row(1, e=D), row(2, e=date(2023, 12, 31)), row(3, s=None, e=D), row(4)])
    assert counted(history.start_after_end(df, SPEC)) == {(2, D, date(2023, 12, 31)): 1}
    assert counted(history.null_start(df, SPEC)) == {(3,): 1}


def raw(spark, rows):
    return spark.createDataFrame([_decimal(r) for r in rows], "k bigint, batch string, v decimal(10,2)")


def test_coverage_counts_rows_and_never_finds_null_keys(spark):
    bronze = raw(spark, [(1, "B1", 1), (2, "B1", 1), (2, "B1", 1), (None, "B1", 1), (3, "B2", 1)])
    df = silver(spark, [row(1, False, "B0"), row(None)])
    found = completeness.key_coverage(bronze, df, SPEC, "B1", "batch")
    assert counted(found) == {(2,): 2, (None,): 1}
    assert counted(completeness.missing_keys(bronze, df, SPEC, "B1", "batch")) == {(2, 2): 1, (None, 1): 1}


def test_repeat_rows_expands_large_counts(spark):
    df = spark.createDataFrame([("a", 25_001), ("b", 1)], f"k string, {COUNT} bigint")
    out = repeat_rows(df)
    assert out.columns == ["k"]
    assert dict(out.groupBy("k").count().collect()) == {"a": 25_001, "b": 1}


def test_batch_id_is_a_value_not_sql(spark):
    bronze = raw(spark, [(1, "B1", 1)])
    assert batch_slice(bronze, "batch", "B1' OR '1'='1").count() == 0


def test_empty_batch_has_a_zero_base(spark):
    bronze = raw(spark, [(1, "B1", 5)])
    df = silver(spark, [row(1, v=5), row(2, b="B9", v=7)])
    rows = completeness.row_count_recon(bronze, df, SPEC, "B9", "batch").first()
    assert (rows["expected_value"], rows["actual_value"], rows["variance_pct"]) == (0.0, 1.0, 0.0)
    assert rows["status"] == "FAIL" and rows["failure_count"] == 1
    sums = completeness.numeric_sum_recon(bronze, df, SPEC, "B9", ["v"], "batch").first()
    assert (sums["check_name"], sums["status"], sums["variance_value"]) == ("numeric_sum_v", "PASS", 7.0)
    strict = completeness.numeric_sum_recon(bronze, df, SPEC, "B9", ["v"], "batch", True).first()
    assert strict["status"] == "FAIL"


def test_counts_take_closed_rows_and_sums_do_not(spark):
    bronze = raw(spark, [(1, "B1", 5), (1, "B1", 6)])
    df = silver(spark, [row(1, False, v=5), row(1, True, v=6)])
    assert completeness.row_count_recon(bronze, df, SPEC, "B1", "batch").first()["status"] == "PASS"
    sums = completeness.numeric_sum_recon(bronze, df, SPEC, "B1", ["v"], "batch").first()
    assert (sums["expected_value"], sums["actual_value"], sums["status"]) == (11.0, 6.0, "FAIL")


def test_sum_tolerance_is_exclusive(spark):
    bronze = raw(spark, [(1, "B1", 100_000)])
    for value, status in ((99_999, "FAIL"), ("99999.01", "PASS")):
        df = silver(spark, [row(1)]).drop("v").selectExpr("*", f"cast({value} as decimal(10,2)) as v")
        found = completeness.numeric_sum_recon(bronze, df, SPEC, "B1", ["v"], "batch").first()
        assert found["status"] == status


def test_ranges_are_inclusive_and_null_passes(spark):
    df = silver(spark, [row(1, v=0), row(2, v=10), row(3, v=-1), row(4, v=11), row(5), row(6, False, v=99)])
    found = rules.numeric_range(df, SPEC, "v", 0, 10).collect()
    assert sorted(r["k"] for r in found) == [3, 4]
    assert sorted(r["k"] for r in rules.numeric_range(df, SPEC, "v", None, 10).collect()) == [4]
    assert counted(rules.numeric_ranges(df, SPEC, {"v": (0, 10)})) == {(3, "v", -1.0): 1, (4, "v", 11.0): 1}
    with pytest.raises(ConfigError):
        rules.numeric_range(df, SPEC, "v", None, None)


def test_required_fields_look_at_current_rows(spark):
    df = silver(spark, [row(1), row(2, v=1), row(3, False), row(None, v=2)])
    assert counted(rules.required_fields(df, SPEC, ["k", "v"])) == {(1, "v"): 1, (None, "k"): 1}


def test_foreign_key_needs_a_current_parent(spark):
    child = spark.createDataFrame(
        [(1, 10, True), (2, 20, True), (3, 30, True), (4, None, True), (5, 30, False), (6, 30, True)],
        "k bigint, p bigint, cur boolean",
    )
    parent = spark.createDataFrame(
        [(10, True), (10, False), (20, False), (20, None)], "id bigint, cur boolean"
    )
    fk = ForeignKey("p", "parent", "id")
    p = HistorySpec(("id",), is_current="cur")
    assert counted(rules.foreign_key(child, parent, SPEC, fk, p)) == {(2, 20): 1, (3, 30): 1, (6, 30): 1}
    assert counted(rules.dangling_values(child, parent, SPEC, fk, p)) == {(20, 1): 1, (30, 2): 1}


def test_rule_is_taken_as_written(spark):
    df = silver(spark, [row(1, False, v=1), row(2, True, v=1), row(3, v=0)])
    assert counted(rules.conditional_rule(df, SPEC, "v > 0")) == {(1,): 1, (2,): 1}
    assert counted(rules.conditional_rule(df, SPEC, "cur = true AND v > 0 OR k = 3")) == {(2,): 1, (3,): 1}


def test_recon_threshold_is_inclusive(spark):
    source = FrameSource({"t": spark.range(200).selectExpr("id as ID", "cast(null as int) as n")})
    df = silver(spark, [row(i) for i in range(198)] + [row(999, False)])
    metrics = [Metric("rows", "COUNT(*)", "COUNT(*)"), Metric("none", "SUM(n)", "SUM(v)")]
    found = {r["metric_name"]: r for r in recon.source_recon(source, "t", df, SPEC, metrics, 1.0).collect()}
    assert found["rows"]["variance_pct"] == -1.0 and found["rows"]["within_threshold"]
    assert (found["none"]["expected_value"], found["none"]["status"]) == (0.0, "PASS")
    tight = recon.source_recon(source, "t", df, SPEC, metrics, 0.99)
    assert {r["metric_name"]: r["status"] for r in tight.collect()} == {"rows": "WARN", "none": "PASS"}
    zero = [Metric("rows", "SUM(0)", "COUNT(*)")]
    assert recon.source_recon(source, "t", df, SPEC, zero).first()["status"] == "PASS"
    assert recon.source_recon(source, "t", df, SPEC, zero, strict_zero_base=True).first()["status"] == "WARN"


def test_jdbc_source_sends_one_query_per_table(spark):
    query = JdbcSource(spark, {"url": "jdbc:none"}).query("dbo.T", {"n": "COUNT(*)", "s": "SUM(x)"})
    assert query == "SELECT COUNT(*) AS n, SUM(x) AS s FROM dbo.T"


def test_config_is_checked():
    with pytest.raises(ConfigError):
        HistorySpec(())
    with pytest.raises(ConfigError):
        TableSpec("t", SPEC, ranges={"v": (None, None)})
    with pytest.raises(ConfigError):
        TableSpec("t", SPEC, metrics=(Metric("n", "COUNT(*)", "COUNT(*)"),))
    registry = Registry([TableSpec("t", SPEC), TableSpec("u", SPEC)])
    assert [t.name for t in registry.select()] == ["t", "u"]
    assert [t.name for t in registry.select("u")] == ["u"]
    with pytest.raises(ConfigError):
        registry.select("missing")


def test_empty_tables(spark):
    df, bronze = silver(spark, []), raw(spark, [])
    assert history.history_profile(df, SPEC).first().asDict() == dict.fromkeys(history.PROFILE, 0)
    assert completeness.row_count_recon(bronze, df, SPEC, "B1", "batch").first()["status"] == "PASS"
    assert history.overlap_counts(df, SPEC).count() == 0


def test_sums_of_doubles_have_the_same_bits_in_any_order(spark):
    import math
    import random

    from tablegate.functions.sums import steady_sum

    r = random.Random(9)
    values = [r.choice([1, -1]) * r.random() * 2.0 ** r.randrange(-18, 60) for _ in range(3000)] + [None, 0.0, -0.0, 0.1]
    found = set()
    for parts in (1, 3, 16):
        r.shuffle(values)
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").repartition(parts, "i")
        found.add(df.agg(steady_sum(df, "v")).first()[0])
    exact = math.fsum(v for v in values if v is not None)
    (only,) = found
    assert abs(only - exact) <= abs(exact) * 2**-50 + 2**-70 * len(values)
    df = spark.createDataFrame([(1e30, True), (-1e30, True), (2.5, False)], "v double, c boolean")
    assert df.agg(steady_sum(df, "v")).first()[0] == 2.5 and df.agg(steady_sum(df, "v", F.col("c"))).first()[0] == 0.0
    assert df.limit(0).agg(steady_sum(df, "v")).first()[0] == 0.0
    none = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert math.isnan(none.agg(steady_sum(none, "v")).first()[0])

"""What the physical plans have to look like."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tablegate.config import ForeignKey, HistorySpec
from tablegate.operators import completeness, history, rules
from tablegate.plans import checks as plan
from tablegate.plans.results import failure_sample
from tablegate.sources.tables import FrameTables, batch_slice
from workload import tables as t


SHUFFLE = r"- Exchange hashpartitioning"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The derived tables as files, as a user would have them."""
    root = tmp_path_factory.mktemp("stored")
    made = t.tables(spark, "/root/testdata/sf0.001")
    raw, curated = {}, {}
    for target, frames, layer in ((raw, made.raw_frames, "raw"), (curated, made.curated_frames, "curated")):
        for name, frame in frames.items():
            path = f"{root}/{layer}_{name}"
            frame.write.parquet(path)
            target[name] = spark.read.parquet(path)
    return FrameTables(raw, curated)


def executed(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def count(pattern: str, text: str) -> int:
    return len(re.findall(pattern, text))


def test_batch_filter_reaches_the_scan(stored):
    text = executed(batch_slice(stored.raw("order"), "_batch_id", "B1").select("order_id"))
    assert "EqualTo(_batch_id,B1)" in text
    assert "ReadSchema: struct<order_id:bigint,_batch_id:string>" in text


RANGES = r"- Exchange rangepartitioning"


def test_history_checks_share_one_scan_and_one_order(stored):
    groups = plan.history_groups(t.REGISTRY["order_line"], stored)
    text = executed(plan.check_results(groups))
    assert count("FileScan", text) == 1
    # One order of the table, read again by the walk that looks for overlaps; the others are of rows that touch others.
    assert count(RANGES + r"\(order_id#\d+L ASC NULLS FIRST, line_number#\d+ ASC NULLS FIRST, effective_start", text) == 1
    assert count(r"ReusedExchange .*effective_start", text) == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_profile_is_one_scan_and_one_exchange(stored):
    text = executed(history.history_profile(stored.curated("order"), t.ORDER))
    assert count("FileScan", text) == 1 and count(RANGES, text) == 1 and count(SHUFFLE, text) == 0
    assert "ReadSchema: struct<order_id:bigint,effective_start_date:date,effective_end_date:date,is_current:boolean>" in text


def test_a_chain_is_one_scan_and_one_exchange(stored):
    text = executed(history.chain_continuity(stored.curated("order"), t.ORDER))
    assert count("FileScan", text) == 1 and count(RANGES, text) == 1 and count(SHUFFLE, text) == 0


def test_no_job_runs_while_a_history_plan_is_built(spark, stored):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    plan.check_results(plan.history_groups(t.REGISTRY["order_line"], stored))
    history.chain_continuity(stored.curated("order"), t.ORDER)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_overlap_pairs_need_one_shuffle_and_no_join(stored):
    text = executed(history.overlapping_ranges(stored.curated("order"), t.ORDER))
    assert count("Exchange", text) == 1 and count("Join", text) == 0


def test_row_rules_are_one_scan_without_a_keyed_shuffle(stored):
    spec = t.REGISTRY.override("order", foreign_keys=())["order"]
    (group,) = plan.rule_groups(spec, stored, t.REGISTRY.__getitem__)
    assert len(group.checks) == 8
    text = executed(group.results())
    assert count("FileScan", text) == 1 and count(SHUFFLE, text) == 0


def test_coverage_is_an_anti_join_of_grouped_keys(spark, stored, monkeypatch):
    frame = completeness.missing_keys(stored.raw("order"), stored.curated("order"), t.ORDER, "B1")
    assert "LeftAnti" in frame._jdf.queryExecution().optimizedPlan().toString()
    # A small batch: the curated keys meet it where they are read, before any exchange.
    text = executed(frame)
    semi = text.index("LeftSemi")
    below = text[semi : text.index("FileScan", semi)]
    assert "BroadcastHashJoin" in text[semi - 80 : semi] and "hashpartitioning" not in below.split("BroadcastExchange")[0]
    # The keys of the batch are stored: the raw table is not read again.
    assert count("FileScan", text) == 1
    monkeypatch.setattr(completeness, "BROADCAST_KEYS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = completeness.missing_keys(stored.raw("order"), stored.curated("order"), t.ORDER, "B1")
        text = executed(frame)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert count(SHUFFLE, text) <= 2 and count("FileScan", text) == 1


def test_coverage_of_a_large_batch_skips_row_groups(spark, tmp_path, monkeypatch):
    """Keys of the batch lie in one of many files; the ranges reach the scan and the other files give no rows."""
    monkeypatch.setattr(completeness, "BROADCAST_KEYS", 1)
    spark.range(0, 80_000, 1, 8).selectExpr("id AS k", "'B' AS _batch_id").write.parquet(f"{tmp_path}/curated")
    raw = spark.range(30_000, 34_000).selectExpr("id + 1 AS k", "'B' AS _batch_id").union(
        spark.createDataFrame([(None, "B"), (-7, "X"), (99_999, "X")], "k long, _batch_id string")
    )
    frame = completeness.missing_keys(raw, spark.read.parquet(f"{tmp_path}/curated"), HistorySpec(("k",)), "B")
    assert [tuple(r) for r in frame.collect()] == [(None, 1)]
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,30001)" in text and "LessThanOrEqual(k,34000)" in text
    scans = [n for n in _nodes(frame._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet")]
    read = [n.metrics().apply("numOutputRows").value() for n in scans]
    assert read and max(read) <= 20_000


def _nodes(plan_node):
    """A plan's nodes, through the stages of an adaptive plan."""
    yield plan_node
    inner = []
    if plan_node.nodeName() == "AdaptiveSparkPlan":
        inner = [plan_node.executedPlan()]
    elif hasattr(plan_node, "plan") and "QueryStage" in plan_node.nodeName():
        inner = [plan_node.plan()]
    children = plan_node.children()
    for child in [*inner, *(children.apply(i) for i in range(children.length()))]:
        yield from _nodes(child)


def test_nothing_is_a_cross_join(stored):
    spec = t.REGISTRY["order"]
    groups = plan.completeness_groups(spec, stored, "B1") + plan.rule_groups(spec, stored, t.REGISTRY.__getitem__)
    text = executed(plan.check_results(groups))
    assert count("CartesianProduct|NestedLoop", text) == 0


def test_samples_are_cut_on_raw_keys_without_a_sort(stored):
    groups = plan.rule_groups(t.REGISTRY["order"], stored, t.REGISTRY.__getitem__)
    (rows,) = [g for g in groups if isinstance(g, plan.RowGroup)]
    text = executed(failure_sample(plan.offenders([rows])))
    assert count(r"\bSort\b", text) == 0 and count("WindowGroupLimit", text) == 0
    # From the top of the plan down: JSON is made above the lowest cut and nowhere below it.
    below = text[text.rindex("MapInArrow") :]
    assert "StructsToJson" in text and "StructsToJson" not in below
    assert count(SHUFFLE, text) <= 2


def test_a_hot_reference_is_split(spark):
    """A third of the rows refers to one missing parent; the adaptive planner splits it."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        child = spark.range(0, 60_000, 1, 8).select(
            F.col("id").alias("k"),
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("p"),
            F.lit(True).alias("cur"),
        )
        parent = spark.range(100_000).select(F.col("id").alias("p"), F.lit(True).alias("cur"))
        spec = HistorySpec(("k",), is_current="cur")
        found = rules.foreign_key(child, parent, spec, ForeignKey("p", "parent", "p"), HistorySpec(("p",), "cur"))
        assert len(found.collect()) == 20_000
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in keys:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "skew=true" in text

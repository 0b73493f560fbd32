"""Overlaps, chains and the profile against brute force, with and without lanes for hot keys."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from brute import broken_chain, overlaps, profile
from pyspark.sql import functions as F

from tablegate.config import HistorySpec
from tablegate.functions.columns import COUNT
from tablegate.operators import history
from tablegate.plans import ordered
from tablegate.plans.lanes import HotKeys, find_hot_keys

SPEC = HistorySpec(("k",), is_current="cur", start="s", end="e")
SCHEMA = "k bigint, s date, e date, cur boolean"
DAY = date(2024, 1, 1)


def rows_of(seed: int, n: int, span: int, long: bool = False) -> list[tuple]:
    """A third of the rows has key 0; starts and ends are often NULL, equal or inverted."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        key = 0 if r.random() < 0.34 else r.choice([None, *range(1, 6)])
        start = None if r.random() < 0.08 else DAY + timedelta(days=r.randrange(span))
        end = None
        if r.random() > 0.1:
            width = r.randrange(-4, 300 if long and r.random() < 0.2 else 9)
            end = (start or DAY) + timedelta(days=width)
        out.append((key, start, end, r.choice([True, False, False, None])))
    copies = [out[0]] * (n // 6)
    return out + copies


CASES = [(2, 200, 60, False), (3, 150, 400, True), (4, 120, 5, False)]


@pytest.fixture(params=CASES, ids=lambda c: f"seed{c[0]}", scope="module")
def case(request, spark):
    rows = rows_of(*request.param)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(params=["plain", "lanes"])
def hot(request, case):
    if request.param == "plain":
        return None
    found = find_hot_keys(case[1], SPEC, hot_rows=12, lane_rows=7)
    assert found
    return found


def counted(frame) -> Counter:
    return Counter(tuple(r) for r in frame.collect())


@pytest.fixture(params=[1, 9], ids=lambda n: f"ranges{n}")
def ranges(request, spark):
    """As many ranges as asked for, so that keys, equal starts and equal rows are parted; few rows in an Arrow batch."""
    settings = {
        "spark.sql.shuffle.partitions": str(request.param),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "5" if request.param == 9 else "10000",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("open_end", [False, True])
def test_overlapping_pairs(case, hot, open_end):
    rows, df = case
    assert counted(history.overlapping_ranges(df, SPEC, hot, open_end)) == overlaps(rows, open_end)


@pytest.mark.parametrize("open_end", [False, True])
def test_overlap_counts(case, ranges, open_end):
    rows, df = case
    per_key = Counter()
    for (key, *_), n in overlaps(rows, open_end).items():
        per_key[key] += n
    assert {r["k"]: r[COUNT] for r in history.overlap_counts(df, SPEC, open_end).collect()} == per_key


def test_chain(case, ranges):
    rows, df = case
    assert counted(history.chain_continuity(df, SPEC)) == broken_chain(rows)


def test_profile(case, ranges):
    rows, df = case
    assert history.history_profile(df, SPEC).first().asDict() == profile(rows)


def test_text_starts(spark, ranges):
    """The same with dates as text, which order alike."""
    rows = rows_of(*CASES[0])
    df = spark.createDataFrame(rows, SCHEMA)
    texts = df.selectExpr("k", "cast(s as string) s", "cast(e as string) e", "cur")
    assert history.history_profile(texts, SPEC).first().asDict() == profile(rows)
    assert sum(r[COUNT] for r in history.overlap_counts(texts, SPEC).collect()) == sum(overlaps(rows).values())


def test_nothing_to_walk_through(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert set(history.history_profile(none, SPEC).first()) == {0}
    assert history.overlap_counts(none, SPEC).count() == history.chain_continuity(none, SPEC).count() == 0


def test_many_versions_use_several_rank_blocks(spark, ranges):
    """One key whose runs of partners are longer than a block of ranks, some of them inverted."""
    rows = [(1, DAY + timedelta(days=i), DAY + timedelta(days=i + 300), False) for i in range(400)]
    rows += [(1, DAY + timedelta(days=i), DAY + timedelta(days=i - 40), False) for i in range(60, 400, 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = overlaps(rows)
    assert counted(history.overlapping_ranges(df, SPEC)) == want
    assert history.overlap_counts(df, SPEC).first()[COUNT] == sum(want.values())


def test_one_key_of_inverted_versions_is_parted(spark, ranges):
    """Every version is inverted, many are equal: no partition holds more than its share of any step."""
    r = random.Random(7)
    rows = []
    for _ in range(600):
        start = r.randrange(80)
        rows.append((1, DAY + timedelta(days=start), DAY + timedelta(days=start - r.randrange(0, 60)), False))
    df = spark.createDataFrame(rows, SCHEMA)
    assert sum(r[COUNT] for r in history.overlap_counts(df, SPEC).collect()) == sum(overlaps(rows).values())
    sizes = [r["n"] for r in ordered.in_order(df, ["k", "s", "e", "cur"]).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == ranges and max(sizes) <= 3 * len(rows) / ranges


def test_equal_rows_are_parted(spark, ranges):
    df = spark.createDataFrame([(1, DAY, DAY, True)] * 400, SCHEMA)
    sizes = ordered.in_order(df, ["k", "s", "e", "cur"]).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == ranges and max(r["count"] for r in sizes) <= 3 * 400 / ranges
    assert history.history_profile(df, SPEC).first()["duplicate_current"] == 1


def test_timestamps_and_composite_keys(spark):
    spec = HistorySpec(("a", "b"), is_current="cur", start="s", end="e")
    t = datetime(2024, 1, 1)
    rows = [("x", 1, t, t + timedelta(hours=2), False), ("x", 1, t + timedelta(hours=1), None, True)]
    rows += [("x", 2, t, t + timedelta(hours=2), True)]
    df = spark.createDataFrame(rows, "a string, b int, s timestamp, e timestamp, cur boolean")
    for hot in (None, find_hot_keys(df, spec, 1, 1)):
        assert history.overlapping_ranges(df, spec, hot).count() == 0
        found = history.overlapping_ranges(df, spec, hot, open_end=True).collect()
        assert len(found) == 2 and {r["b_end"] for r in found} == {None, t + timedelta(hours=2)}
    broken = history.chain_continuity(df, spec).collect()
    assert [r["next_start"] for r in broken] == [t + timedelta(hours=1)]
    assert [tuple(r) for r in history.overlap_counts(df, spec, open_end=True).collect()] == [("x", 1, 2)]


def test_hot_keys_are_found_and_cut(spark):
    rows = [(0, DAY + timedelta(days=i % 90), None, False) for i in range(900)]
    rows += [(i, DAY, None, True) for i in range(1, 900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    hot = find_hot_keys(df, SPEC, hot_rows=500, lane_rows=100)
    assert len(hot.splits) == 1
    cuts = next(iter(hot.splits.values()))
    assert 9 <= len(cuts) <= 18 and list(cuts) == sorted(cuts)
    for kind in ("timestamp", "timestamp_ntz"):
        other = df.selectExpr("k", f"cast(s as {kind}) as s")
        assert len(next(iter(find_hot_keys(other, SPEC, 500, 100).splits.values()))) == len(cuts)
    texts = find_hot_keys(df.selectExpr("k", "cast(s as string) as s"), SPEC, 500, 100)
    assert len(next(iter(texts.splits.values()))) >= 4
    assert not find_hot_keys(df, SPEC)
    assert not find_hot_keys(df.limit(0), SPEC)


def test_lanes_split_the_windows_of_a_hot_key(spark):
    from tablegate.plans.lanes import LANE, spread

    rows = [(0, DAY + timedelta(days=i % 90), None, False) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    hot = find_hot_keys(df, SPEC, 500, 100)
    lanes = spread(df.select("k", "s", "e", "cur"), ("k",), "s", hot).groupBy(LANE).sum(COUNT).collect()
    assert len(lanes) >= 6 and max(r[1] for r in lanes) <= 250
    assert sum(r[1] for r in lanes) == 900


def test_a_hot_key_without_any_start(spark):
    rows = [(0, None, DAY, False)] * 30
    df = spark.createDataFrame(rows, SCHEMA)
    hot = find_hot_keys(df, SPEC, 10, 5)
    assert isinstance(hot, HotKeys) and hot
    assert history.history_profile(df, SPEC).first()["null_start"] == 30
    assert history.overlapping_ranges(df, SPEC, hot).count() == 0


def test_keys_of_a_ten_thousandth_of_the_rows_are_found(spark):
    """Twenty keys of 4,000 rows among twenty million."""
    key = F.when(F.col("id") < 80_000, F.col("id") % 20).otherwise(F.col("id"))
    start = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 3000).cast("int"))
    df = spark.range(20_000_000).select(key.alias("k"), start.alias("s"))
    hot = find_hot_keys(df, SPEC, hot_rows=2000, lane_rows=1000)
    assert len(hot.splits) == 20 and all(len(cuts) >= 2 for cuts in hot.splits.values())


def test_pairs_do_not_depend_on_a_folder(spark, monkeypatch):
    rows = [(1, date(2020, 1, 1 + i % 28), date(2020, 1, 3 + i % 20), True) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, s date, e date, cur boolean")
    hot = find_hot_keys(df, SPEC, 100, 50)
    want = history.overlapping_ranges(df, SPEC, hot).count()
    assert history.overlap_counts(df, SPEC).first()[COUNT] == want
    monkeypatch.setattr(history, "has_shared_folder", lambda spark: False)
    assert hot and history.overlapping_ranges(df, SPEC, hot).count() == want

"""Listing the pairs of a business key with a huge number of versions.

Windows partitioned by key put all versions of a key into one task. That is the right plan
for the usual handful of versions, but not for a key that holds a large share of the table.
``find_hot_keys`` counts the keys of a sample, each by itself, and picks split points on the
starts of the large ones. ``spread`` then
cuts each hot key into lanes, ranges of start dates that are windowed separately, and
``carried`` hands per-lane totals from lane to lane. A table without hot keys gets the plain
window plan.

The sample only steers the layout: every row takes part in the checks, and results are the same
whatever keys it finds. It is as large a share of the rows as shows about ``_SEEN_ROWS`` rows of a
key that is just hot. Should more than ``MOST_KEYS`` keys be hot, the largest are cut: each of the
others holds less than one row in ``MOST_KEYS``, which is no more than a task's share of a table
that large.

Lanes cannot part versions with equal starts. Equal rows are merged before they are shuffled,
so such a lane holds at most one row per distinct pair of end and flag.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from math import ceil, log2, sqrt

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.config import HistorySpec
from tablegate.functions.columns import COUNT, col, cols

HOT_ROWS = 1_000_000
LANE_ROWS = 1_000_000
LANE = "_lane"
_HASH = "_key_hash"
_COLD = -1
_WITH_QUANTILES = (T.DateType, T.TimestampType, T.TimestampNTZType, T.NumericType)
_SEEN_ROWS = 10_000
MOST_KEYS = 100_000


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the hot keys, each with ascending split points of the start column.

    Holds at most ``MOST_KEYS`` keys and about one split per ``lane_rows`` rows of a hot key, two
    at most.
    """

    splits: Mapping[int, Sequence] = field(default_factory=dict)
    start_type: T.DataType | None = None

    def __bool__(self) -> bool:
        return bool(self.splits)


def find_hot_keys(
    df: DataFrame, spec: HistorySpec, hot_rows: int = HOT_ROWS, lane_rows: int = LANE_ROWS
) -> HotKeys:
    """Keys with about ``hot_rows`` versions or more. Runs one job, two if there are any."""
    start_type = df.schema[spec.start].dataType
    share = min(1.0, _SEEN_ROWS / hot_rows)
    hashed = df.select(F.xxhash64(*cols(spec.keys)).alias(_HASH), col(spec.start).alias("_s"))
    if share < 1:
        hashed = hashed.sample(share, seed=0)
    counts = hashed.groupBy(_HASH).agg(F.count("*").alias(COUNT)).where(F.col(COUNT) >= hot_rows * share)
    by_lanes: dict[int, list[int]] = {}
    for r in counts.orderBy(F.col(COUNT).desc(), _HASH).limit(MOST_KEYS).collect():
        lanes = 1 << ceil(log2(max(2, r[COUNT] / share / lane_rows)))
        by_lanes.setdefault(lanes, []).append(r[_HASH])
    if not by_lanes:
        return HotKeys()
    cuts = reduce(DataFrame.unionByName, [_cuts(hashed, lanes, keys) for lanes, keys in by_lanes.items()])
    return HotKeys({r[_HASH]: sorted(set(r["_cuts"] or [])) for r in cuts.collect()}, start_type)


def _cuts(rows: DataFrame, lanes: int, hashes: Sequence[int]) -> DataFrame:
    """Starts that cut each of the keys into ``lanes`` lanes of about equal size.

    Starts without quantiles, such as strings, are cut at those of a sample of distinct values: for
    each of a fixed number of hash values the start with the smallest second hash.
    """
    rows = _of_keys(rows, hashes, "left_semi")
    if isinstance(rows.schema["_s"].dataType, _WITH_QUANTILES):
        marks = [i / lanes for i in range(1, lanes)]
        cuts = F.percentile_approx("_s", marks, max(10_000, 10 * lanes)).alias("_cuts")
    else:
        draw = F.pmod(F.xxhash64("_s"), F.lit(max(1024, 16 * lanes))).alias("_draw")
        rows = rows.groupBy(_HASH, draw).agg(F.min_by("_s", F.xxhash64("_s", F.lit(1))).alias("_s"))
        at = F.sequence(F.lit(1), F.lit(lanes - 1))
        every = F.sort_array(F.collect_list("_s"))
        cuts = F.transform(at, lambda i: F.get(every, F.floor(i * F.size(every) / lanes).cast("int"))).alias("_cuts")
    return rows.groupBy(_HASH).agg(cuts)


def _of_keys(rows: DataFrame, hashes: Sequence[int], how: str) -> DataFrame:
    """Rows whose key hash is, or is not, one of at most ``MOST_KEYS``."""
    names = rows.sparkSession.createDataFrame([(h,) for h in hashes], f"{_HASH} long")
    return rows.join(F.broadcast(names), _HASH, how)


def _split_table(df: DataFrame, hot: HotKeys) -> DataFrame:
    """(hash, split points in groups of equal width). The planner knows its size and joins by it."""
    rows = []
    for h, points in hot.splits.items():
        width = max(1, ceil(sqrt(len(points))))
        rows.append((h, width, [list(points[i : i + width]) for i in range(0, len(points), width)]))
    schema = T.StructType(
        [
            T.StructField(_HASH, T.LongType()),
            T.StructField("_width", T.IntegerType()),
            T.StructField("_groups", T.ArrayType(T.ArrayType(hot.start_type))),
        ]
    )
    return df.sparkSession.createDataFrame(rows, schema)


def with_lane(df: DataFrame, keys: Sequence[str], at: str, hot: HotKeys) -> DataFrame:
    """Add the lane of the value in ``at``; rows of other keys get one lane per key."""
    value = col(at)
    group = F.size(F.filter("_groups", lambda g: g[0] <= value))
    inside = F.size(F.filter(F.element_at("_groups", F.col("_group")), lambda x: x <= value))
    return (
        df.withColumn(_HASH, F.xxhash64(*cols(keys)))
        .join(_split_table(df, hot), _HASH, "left")
        .withColumn("_group", F.when(F.col("_groups").isNotNull(), group))
        .withColumn(
            LANE,
            F.when(F.col("_group").isNull(), F.lit(_COLD))
            .when(F.col("_group") == 0, F.lit(0))
            .otherwise((F.col("_group") - 1) * F.col("_width") + inside),
        )
        .drop(_HASH, "_width", "_groups", "_group")
    )


def spread(df: DataFrame, keys: Sequence[str], start: str, hot: HotKeys | None) -> DataFrame:
    """Rows ready for windows over ``lane_keys``, with a ``COUNT`` of equal rows each.

    Equal rows of hot keys are merged before they are shuffled.
    """
    if not hot:
        return df.withColumn(COUNT, F.lit(1).cast("bigint"))
    hashed = df.withColumn(_HASH, F.xxhash64(*cols(keys)))
    hot_rows, cold = (_of_keys(hashed, list(hot.splits), how).drop(_HASH) for how in ("left_semi", "left_anti"))
    cold = cold.withColumn(COUNT, F.lit(1).cast("bigint")).withColumn(LANE, F.lit(_COLD))
    merged = hot_rows.groupBy(*cols(df.columns)).agg(F.count("*").alias(COUNT))
    return cold.unionByName(with_lane(merged, keys, start, hot))


def lane_keys(keys: Sequence[str], hot: HotKeys | None) -> list[Column]:
    return cols(keys) + ([F.col(LANE)] if hot else [])


def carried(
    df: DataFrame,
    keys: Sequence[str],
    totals: Mapping[str, tuple[Column, Callable[[str, WindowSpec], Column]]],
) -> DataFrame:
    """Add a column per entry of ``totals``: a lane total seen from the other lanes of its key.

    An entry is an aggregate per lane and the window function to apply to it over the lanes of
    a key in order. The table of lanes has one row per lane; the planner sends it to every task
    if it is small, and else joins on key and lane, which no hot key can overload. Rows of other
    keys get NULL.

    All totals of a step share one table, as each table computes its input a second time.
    """
    names = [f"_carry_{i}" for i in range(len(keys))]
    order = Window.partitionBy(*names).orderBy("_carry_lane")
    lanes = (
        df.where(F.col(LANE) != _COLD)
        .groupBy(*[col(k).alias(n) for k, n in zip(keys, names)], F.col(LANE).alias("_carry_lane"))
        .agg(*[total.alias(f"_total{name}") for name, (total, _) in totals.items()])
        .select(
            *names,
            "_carry_lane",
            *[over(f"_total{name}", order).alias(name) for name, (_, over) in totals.items()],
        )
    )
    match = F.col(LANE) == F.col("_carry_lane")
    for k, n in zip(keys, names):
        match = match & col(k).eqNullSafe(F.col(n))
    return df.join(lanes, match, "left").drop("_carry_lane", *names)


def following(total: str, lanes: WindowSpec) -> Column:
    """The total of the next lane."""
    return F.lead(total).over(lanes)


def largest_before(total: str, lanes: WindowSpec) -> Column:
    return F.max(total).over(lanes.rowsBetween(Window.unboundedPreceding, -1))


def sum_before(total: str, lanes: WindowSpec) -> Column:
    return F.coalesce(F.sum(total).over(lanes.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

"""Integrity of version histories. Every check returns the offending rows or keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tablegate.config import HistorySpec
from tablegate.functions.columns import COUNT, col, cols, none_null, repeat_rows
from tablegate.plans import ordered
from tablegate.plans.lanes import (
    HotKeys,
    carried,
    following,
    lane_keys,
    largest_before,
    spread,
    sum_before,
    with_lane,
)
from tablegate.sources.shared import checkpointed, has_shared_folder
from tablegate.sources.tables import current

_RANK_BLOCK = 128


# --- predicates on single rows ------------------------------------------------------------


def is_null_start(spec: HistorySpec) -> Column:
    return col(spec.start).isNull()


def is_open_closed(spec: HistorySpec) -> Column:
    """A closed version without an end."""
    return ~col(spec.is_current) & col(spec.end).isNull()


def is_inverted(spec: HistorySpec) -> Column:
    return col(spec.end).isNotNull() & (col(spec.start) > col(spec.end))


def null_start(df: DataFrame, spec: HistorySpec) -> DataFrame:
    return df.where(is_null_start(spec)).select(*cols(spec.keys))


def null_end_on_closed(df: DataFrame, spec: HistorySpec) -> DataFrame:
    return df.where(is_open_closed(spec)).select(*cols(spec.keys))


def start_after_end(df: DataFrame, spec: HistorySpec) -> DataFrame:
    return df.where(is_inverted(spec)).select(*cols(spec.keys), col(spec.start), col(spec.end))


# --- one group per key --------------------------------------------------------------------


def current_per_key(df: DataFrame, spec: HistorySpec) -> DataFrame:
    """(keys, cnt): number of current versions of every key. NULL keys form one group."""
    return df.groupBy(*cols(spec.keys)).agg(F.count_if(col(spec.is_current)).alias("cnt"))


def duplicate_current(df: DataFrame, spec: HistorySpec) -> DataFrame:
    """Keys with more than one current version, with their number."""
    counts = current(df, spec).groupBy(*cols(spec.keys)).agg(F.count("*").alias("cnt"))
    return counts.where(F.col("cnt") > 1)


def orphan_keys(df: DataFrame, spec: HistorySpec) -> DataFrame:
    """Keys without any current version."""
    return current_per_key(df, spec).where(F.col("cnt") == 0).select(*cols(spec.keys))


# --- order of versions --------------------------------------------------------------------
#
# Counts and chains walk through one global order of keys, start, end and flag (plans/ordered.py), so several of them in
# one plan shuffle the table once. Listing the pairs of overlaps brings partners together by windows per key.


def _in_order(df: DataFrame, spec: HistorySpec, hot: HotKeys | None) -> DataFrame:
    """Versions in order of start, end and flag, each with what surrounds it.

    ``next_start`` is the start of the next version, ``_reach`` the latest end of the earlier
    ones, ``_n`` the number of equal rows a row stands for.
    """
    keys, start, end = spec.keys, spec.start, spec.end
    ordered = [start, end, *([spec.is_current] if spec.is_current in df.columns else [])]
    rows = spread(df.select(*cols([*keys, *ordered])), keys, start, hot)
    order = Window.partitionBy(*lane_keys(keys, hot)).orderBy(*cols(ordered))
    next_start = F.lead(col(start)).over(order)
    reach = F.max(col(end)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    if not hot:
        return rows.withColumns({"next_start": next_start, "_reach": reach})
    rows = carried(
        rows,
        keys,
        {"_later": (F.min(col(start)), following), "_before": (F.max(col(end)), largest_before)},
    )
    last_in_lane = F.lead(F.lit(True)).over(order).isNull()
    return rows.withColumns(
        {
            "next_start": F.when(last_in_lane, F.col("_later")).otherwise(next_start),
            "_reach": F.greatest(reach, F.col("_before")),
        }
    ).drop("_later", "_before")


def chain_continuity(df: DataFrame, spec: HistorySpec) -> DataFrame:
    """Closed versions that do not end where the next version of the key starts.

    Versions with the same start are ordered by end, then flag. A NULL end is not reported.
    """
    return ordered.broken_chain(df, spec.keys, spec.start, spec.end, spec.is_current)


PROFILE = (
    "duplicate_current",
    "orphan_keys",
    "null_start",
    "null_end_on_closed",
    "start_after_end",
    "chain_continuity",
)


def history_profile(df: DataFrame, spec: HistorySpec) -> DataFrame:
    """One row with the number of violations of each check in ``PROFILE``, all from one walk through the versions in
    order, which costs one scan and one shuffle whatever the number of versions of a key."""
    return ordered.profile(df, spec.keys, spec.start, spec.end, spec.is_current)


# Two versions a and b of a key overlap when a.start < b.end, a.end > b.start and their starts
# differ. With a the earlier one this means: b starts inside a, and b does not end before a
# starts, which only an inverted b can do. The versions that start inside a are a contiguous
# run in start order, so two ranks describe all partners of a. Ranks alone give the number of
# pairs, and blocks of ranks bring together only rows that do pair up.


def _beyond(df: DataFrame, spec: HistorySpec) -> Column:
    """A point in time after every regular end."""
    return F.date_add(F.lit("9999-12-31").cast("date"), 1).cast(df.schema[spec.end].dataType)


def _ranked(
    df: DataFrame, spec: HistorySpec, hot: HotKeys | None, open_end: bool
) -> DataFrame:
    """Earlier versions (_kind 0) with the run of later versions inside them, and those (_kind 1).

    With hot keys this runs a job that stores the rows touching other rows, if the session names a
    folder for that; without one they are computed again where they are needed.

    The run is [_lo, _hi) in ranks; the rank of a later version is _hi - 1.
    """
    keys, start = spec.keys, spec.start
    until = col(spec.end)
    if open_end:
        df = df.withColumn(spec.end, F.coalesce(until, _beyond(df, spec)))
    rows = _in_order(df, spec, hot)
    # Most rows touch no other row and leave the plan here.
    usable = none_null([*keys, start])
    outer = F.coalesce(usable & (F.col("next_start") < until), F.lit(False))
    inner = F.coalesce(usable & until.isNotNull() & (F.col("_reach") > col(start)), F.lit(False))
    rows = rows.withColumns({"_outer": outer, "_inner": inner}).where(F.col("_outer") | F.col("_inner"))
    if hot and has_shared_folder(df.sparkSession):
        # Each step below reads its input twice, for the rows and for the totals of the lanes.
        rows = checkpointed(rows)

    def running(frame: DataFrame, is_later: Column, window: WindowSpec, prefix: str) -> DataFrame:
        one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        units = {"": F.coalesce(F.when(is_later, one), none)}
        if not hot:
            return frame.withColumns({prefix + x: F.sum(u).over(window) for x, u in units.items()})
        frame = carried(frame, keys, {f"_base{x}": (F.sum(u), sum_before) for x, u in units.items()})
        sums = {
            prefix + x: F.sum(u).over(window) + F.coalesce(F.col(f"_base{x}"), none)
            for x, u in units.items()
        }
        return frame.withColumns(sums).drop(*[f"_base{x}" for x in units])

    by_start = Window.partitionBy(*lane_keys(keys, hot)).orderBy(col(start))
    upto = by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = running(rows, F.col("_inner"), upto, "_lo")
    events = F.filter(
        F.array(
            F.when(F.col("_outer"), F.struct(until.alias("at"), F.lit(0).alias("kind"))),
            F.when(F.col("_inner"), F.struct(col(start).alias("at"), F.lit(1).alias("kind"))),
        ),
        lambda e: e.isNotNull(),
    )
    los = [c for c in rows.columns if c.startswith("_lo")]
    base = [*cols([*keys, start, spec.end]), F.col(COUNT), *los]
    rows = rows.select(*base, F.explode(events).alias("_event")).select(
        *base, F.col("_event.at").alias("_at"), F.col("_event.kind").alias("_kind")
    )
    if hot:
        rows = with_lane(rows, keys, "_at", hot)
    by_event = Window.partitionBy(*lane_keys(keys, hot)).orderBy(
        F.col("_at"), F.col("_kind"), *cols([start, spec.end])
    )
    upto = by_event.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = running(rows, F.col("_kind") == 1, upto, "_hi")
    return rows.where((F.col("_kind") == 1) | (F.col("_hi") > F.col("_lo")))


def _last_block() -> Column:
    return F.floor((F.col("_hi") - 1) / _RANK_BLOCK)


def _run_blocks() -> Column:
    return F.sequence(F.floor(F.col("_lo") / _RANK_BLOCK), _last_block())


def _with_partners(rows: DataFrame, spec: HistorySpec, hot: HotKeys | None, blocks: Column) -> DataFrame:
    """Earlier versions, once for each of their ``blocks``, with the later versions of that block."""
    own = F.when(F.col("_kind") == 1, F.array(_last_block())).otherwise(blocks)
    rows = rows.withColumn("_block", F.explode(own))
    if hot:
        rows = rows.repartition(*cols(spec.keys), F.col("_block"))
    later = F.struct(
        (F.col("_hi") - 1).alias("rank"),
        col(spec.start).alias("start"),
        col(spec.end).alias("end"),
        F.col(COUNT).alias("n"),
    )
    block = Window.partitionBy(*cols(spec.keys), F.col("_block"))
    near = F.collect_list(F.when(F.col("_kind") == 1, later)).over(block)
    inside = F.filter("_near", lambda b: (b["rank"] >= F.col("_lo")) & (b["rank"] < F.col("_hi")))
    return rows.withColumn("_near", near).where(F.col("_kind") == 0).withColumn("_near", inside)


def overlapping_ranges(
    df: DataFrame, spec: HistorySpec, hot: HotKeys | None = None, open_end: bool = False
) -> DataFrame:
    """Pairs of overlapping versions of a key, each pair in both orders.

    A NULL end never overlaps, unless ``open_end`` makes it unlimited. Equal starts and ranges
    that only touch do not overlap.
    """
    start, end = col(spec.start), col(spec.end)
    rows = _with_partners(_ranked(df, spec, hot, open_end), spec, hot, _run_blocks())
    found = F.filter("_near", lambda b: b["end"] > start)
    rows = rows.select(*cols(spec.keys), start, end, F.col(COUNT), F.explode(found).alias("_b"))
    a, b = (start, end), (F.col("_b.start"), F.col("_b.end"))
    names = ("a_start", "a_end", "b_start", "b_end")
    both = F.array(
        F.struct(*[c.alias(n) for c, n in zip((*a, *b), names)]),
        F.struct(*[c.alias(n) for c, n in zip((*b, *a), names)]),
    )
    out = rows.select(
        *cols(spec.keys), (F.col(COUNT) * F.col("_b.n")).alias(COUNT), F.explode(both).alias("_p")
    ).select(*cols(spec.keys), *[F.col(f"_p.{n}").alias(n) for n in names], F.col(COUNT))
    if open_end:
        out = out.withColumns({n: F.nullif(F.col(n), _beyond(df, spec)) for n in ("a_end", "b_end")})
    return repeat_rows(out) if hot else out.drop(COUNT)


def overlap_counts(df: DataFrame, spec: HistorySpec, open_end: bool = False) -> DataFrame:
    """(keys, count): rows of ``overlapping_ranges`` per key, without building the pairs.

    A walk through the versions in order leaves out those that touch no other; the rest is counted by orders in time.
    The work grows with n log n in the number of versions of keys with inverted ones, and of all others with their sort.
    """
    if open_end:
        df = df.withColumn(spec.end, F.coalesce(col(spec.end), _beyond(df, spec)))
    flag = [spec.is_current] if spec.is_current in df.columns else []
    rows = ordered.touching(df, spec.keys, spec.start, spec.end, [spec.start, spec.end, *flag])
    return ordered.overlap_counts(rows, spec.keys, spec.start, spec.end)

"""One layout for ordered work per business key, whatever the number of versions of a key.

Rows are cut into ranges of (key, start, end, ...) and sorted, so the partitions are one global order and a key with a
huge number of versions lies in many of them. A number for each row comes last in the order, so even equal rows can be
parted. A task walks its rows once, Arrow batch by Arrow batch, and gives out what concerns its own rows alone, plus a
boundary row that says how it begins and ends. Boundary rows, one per partition, are put together in order; nothing is
computed before the plan runs, and no setting or sample of this package steers the layout.

``ordered_pairs`` is the same for counts of pairs: of each segment of the order only sums leave a task, and sums of
neighbouring parts of a segment add up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.columns import COUNT, col, cols
from tablegate.sources.shared import find_package

_ROW = "_row"
PART = "_part"


def in_order(df: DataFrame, by: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows in partitions that are consecutive ranges of ``by``, sorted by it, NULL first."""
    find_package(df.sparkSession)
    order = [*cols(by), F.col(_ROW)]
    rows = df.withColumn(_ROW, F.monotonically_increasing_id())
    rows = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    return rows.sortWithinPartitions(*order).drop(_ROW)


def _same(left: pa.ChunkedArray, right: pa.ChunkedArray) -> np.ndarray:
    """Which values agree; NULL agrees with NULL, NaN with NaN."""
    equal = pc.fill_null(pc.equal(left, right), False)
    if pa.types.is_floating(left.type):
        nan = pc.and_(pc.is_nan(left), pc.is_nan(right))
        equal = pc.or_(equal, pc.fill_null(nan, False))
    both = pc.and_(pc.is_null(left), pc.is_null(right))
    return pc.or_(equal, both).to_numpy()


def _true(mask: pa.ChunkedArray) -> np.ndarray:
    """Where a condition holds; NULL is false."""
    return pc.fill_null(mask, False).to_numpy()


def _codes(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Numbers in the order of the values, comparable among the columns; NULL below all others."""
    kind = columns[0].type
    if pa.types.is_temporal(kind):
        wide = pa.int32() if pa.types.is_date32(kind) else pa.int64()
        columns = tuple(c.cast(wide).cast(pa.int64()) for c in columns)
    elif not pa.types.is_integer(kind):
        flat = [x for c in columns for x in c.drop_null().to_pylist()]
        _, places = np.unique(np.array(flat, object), return_inverse=True)
        out, at = [], 0
        for c in columns:
            code, valid = np.full(len(c), np.iinfo(np.int64).min), c.is_valid().to_numpy()
            code[valid] = places[at : at + valid.sum()]
            out, at = [*out, code], at + valid.sum()
        return out
    return [c.cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy() for c in columns]


def _walk(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray, bool]]:
    """(rows, same, is first): each batch after the last row of the one before it.

    ``same[i]`` says that rows i and i + 1 have the same key, which the first ``keys`` columns are.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        same = np.ones(len(rows) - 1, bool)
        for i in range(keys):
            same &= _same(rows.column(i)[:-1], rows.column(i)[1:])
        yield rows, same, held is None
        held = rows.slice(len(rows) - 1)


def _fields(df: DataFrame, names: Sequence[str], prefix: str) -> list[T.StructField]:
    return [T.StructField(f"{prefix}{i}", df.schema[n].dataType) for i, n in enumerate(names)]


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _row_of(schema: pa.Schema, values: dict) -> pa.RecordBatch:
    """One row; values are Python objects or Arrow scalars."""
    scalars = [v if isinstance(v, pa.Scalar) else pa.scalar(v, f.type) for f in schema for v in [values[f.name]]]
    return pa.RecordBatch.from_arrays([pa.repeat(v, 1).cast(f.type) for v, f in zip(scalars, schema)], schema=schema)


def _batches(columns: Sequence, schema: pa.Schema) -> list[pa.RecordBatch]:
    table = pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    return table.combine_chunks().to_batches()


# --- history profile ----------------------------------------------------------------------

_COUNTS = ("duplicate", "orphan", "no_start", "no_end", "inverted", "broken")


def _summaries(keys: int, schema: pa.Schema):
    """One boundary row for a partition of (keys, start, end, flag) with the counts that its own rows settle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, cur_first, cur = None, None, None, 0
        counts = dict.fromkeys(_COUNTS, 0)
        for rows, same, is_first in _walk(batches, keys):
            if is_first:
                first = rows.slice(0, 1)
            last = rows.slice(len(rows) - 1)
            start, end, flag = (rows.column(keys + i) for i in range(3))
            own = slice(0 if is_first else 1, None)
            not_current = _true(pc.invert(flag))
            counts["no_start"] += int(pc.is_null(start).to_numpy()[own].sum())
            counts["no_end"] += int((not_current & pc.is_null(end).to_numpy())[own].sum())
            counts["inverted"] += int(_true(pc.greater(start, end))[own].sum())
            counts["broken"] += int((same & not_current[:-1] & _true(pc.not_equal(end[:-1], start[1:]))).sum())
            # Segments of equal keys; the first one goes on from the batch before.
            segment = np.cumsum(~same) if not is_first else np.concatenate(([0], np.cumsum(~same)))
            per = np.bincount(segment, _true(flag)[own], int(segment[-1]) + 1).astype(np.int64)
            per[0] += cur
            closed = per[:-1]
            if len(closed) and cur_first is None:
                cur_first, closed = int(closed[0]), closed[1:]
            counts["duplicate"] += int((closed > 1).sum())
            counts["orphan"] += int((closed == 0).sum())
            cur = int(per[-1])
        if first is None:
            return
        single = cur_first is None
        out = {PART: TaskContext.get().partitionId(), "single": single, "cur_last": cur, **counts}
        out["cur_first"] = cur if single else cur_first
        for i in range(keys):
            out |= {f"a{i}": first.column(i)[0], f"z{i}": last.column(i)[0]}
        out |= {"a_start": first.column(keys)[0], "z_end": last.column(keys + 1)[0], "z_flag": last.column(keys + 2)[0]}
        yield _row_of(schema, out)

    return run


def _agree(left: Sequence[str], right: Sequence[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def profile(df: DataFrame, keys: Sequence[str], start: str, end: str, flag: str) -> DataFrame:
    """One row: keys with several and with no current version, rows without start, closed rows without end, inverted
    rows, closed rows whose end is not the next start of the key. One scan, one shuffle, and a row per partition."""
    rows = in_order(df.select(*cols([*keys, start, end, flag])), [*keys, start, end, flag])
    first, last = [f"a{i}" for i in range(len(keys))], [f"z{i}" for i in range(len(keys))]
    edges = [T.StructField("a_start", df.schema[start].dataType), T.StructField("z_end", df.schema[end].dataType)]
    schema = T.StructType(
        [
            *_longs(PART, *_COUNTS, "cur_first", "cur_last"),
            *_fields(df, keys, "a"),
            *_fields(df, keys, "z"),
            *edges,
            T.StructField("z_flag", T.BooleanType()),
            T.StructField("single", T.BooleanType()),
        ]
    )
    made = rows.mapInArrow(_summaries(len(keys), _arrow(schema)), schema)
    order = Window.orderBy(PART)
    follows = [f"n{i}" for i in range(len(keys))]
    made = made.withColumns({n: F.lead(a).over(order) for n, a in zip(follows, first)})
    made = made.withColumns({"n_start": F.lead("a_start").over(order), "n_any": F.lead(F.lit(True)).over(order)})
    across = F.coalesce(F.col("n_any"), F.lit(False)) & _agree(last, follows)
    across = across & ~F.col("z_flag") & (F.col("z_end") != F.col("n_start"))
    none = F.lit(0).cast("bigint")
    broken = F.col("broken") + F.when(across, 1).otherwise(0)
    # Keys of the first and the last row may go on in the neighbours; the keys between are settled.
    counts = {**{c: F.col(c) for c in _COUNTS}, "broken": broken}
    begins = F.struct(*[F.col(a).alias(f"k{i}") for i, a in enumerate(first)], F.col("cur_first").alias("cnt"), *[c.alias(n) for n, c in counts.items()])
    ends = F.struct(*[F.col(z).alias(f"k{i}") for i, z in enumerate(last)], F.col("cur_last").alias("cnt"), *[none.alias(n) for n in counts])
    edges = made.select(F.inline(F.array_compact(F.array(begins, F.when(~F.col("single"), ends)))))
    per_key = edges.groupBy(*[f"k{i}" for i in range(len(keys))]).agg(F.sum("cnt").alias("cnt"), *[F.sum(n).alias(n) for n in _COUNTS])
    total = lambda name, more=none: F.coalesce(F.sum(name), none) + more
    return per_key.agg(
        total("duplicate", F.count_if(F.col("cnt") > 1)).alias("duplicate_current"),
        total("orphan", F.count_if(F.col("cnt") == 0)).alias("orphan_keys"),
        total("no_start").alias("null_start"),
        total("no_end").alias("null_end_on_closed"),
        total("inverted").alias("start_after_end"),
        total("broken").alias("chain_continuity"),
    )


# --- chains -------------------------------------------------------------------------------


def _breaks(keys: int, schema: pa.Schema):
    """Broken links between the rows of a partition (edge 0), and its first and last row (edge 1 and 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None

        def rows_out(rows: pa.Table, next_start: pa.ChunkedArray, edge: int) -> list[pa.RecordBatch]:
            n = len(rows)
            ends = [pa.array(np.full(n, v, np.int64)) for v in (part, edge)]
            return _batches([*rows.columns, next_start, *ends], schema)

        for rows, same, is_first in _walk(batches, keys):
            start, end, flag = (rows.column(keys + i) for i in range(3))
            if is_first:
                yield from rows_out(rows.slice(0, 1), start[:1], 1)
            broken = same & _true(pc.invert(flag))[:-1] & _true(pc.not_equal(end[:-1], start[1:]))
            at = pa.array(np.flatnonzero(broken))
            yield from rows_out(rows.take(at), start.take(pc.add(at, 1)), 0)
            last = rows.slice(len(rows) - 1)
        if last is not None:
            yield from rows_out(last, last.column(keys), 2)

    return run


def broken_chain(df: DataFrame, keys: Sequence[str], start: str, end: str, flag: str) -> DataFrame:
    """(keys, start, end, next_start) of closed rows whose end is not the next start of the key."""
    rows = in_order(df.select(*cols([*keys, start, end, flag])), [*keys, start, end, flag])
    names = [f"k{i}" for i in range(len(keys))]
    kinds = [df.schema[n].dataType for n in (start, end)]
    schema = T.StructType(
        [
            *_fields(df, keys, "k"),
            T.StructField("s", kinds[0]),
            T.StructField("e", kinds[1]),
            T.StructField("f", T.BooleanType()),
            T.StructField("next", kinds[0]),
            *_longs(PART, "edge"),
        ]
    )
    made = rows.mapInArrow(_breaks(len(keys), _arrow(schema)), schema)
    order = Window.orderBy(PART, "edge")
    follows = [f"n{n}" for n in names]
    edges = made.where("edge > 0").withColumns({f: F.lead(n).over(order) for f, n in zip(follows, names)})
    edges = edges.withColumns({"next": F.lead("s").over(order), "n_edge": F.lead("edge").over(order)})
    across = (F.col("edge") == 2) & (F.col("n_edge") == 1) & _agree(names, follows)
    across = across & ~F.col("f") & (F.col("e") != F.col("next"))
    found = made.where("edge = 0").select(*names, "s", "e", "next").union(edges.where(across).select(*names, "s", "e", "next"))
    return found.toDF(*keys, start, end, "next_start")


# --- overlaps -----------------------------------------------------------------------------


def _running_max(values: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """The largest value of the segment so far; segments are numbered in order."""
    levels, rank = np.unique(values, return_inverse=True)
    base = segment * len(levels)
    return levels[np.maximum.accumulate(base + rank) - base]


def _touching(keys: int):
    """Rows of (keys, start, end, ...) that a neighbour of their key reaches into, and those that may have one in the
    next partition: the last row, and the rows of the first key, of which earlier ones are not known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach, in_first, last = None, True, None

        def usable(rows: pa.Table) -> np.ndarray:
            out = np.ones(len(rows), bool)
            for i in range(keys + 2):
                out &= rows.column(i).is_valid().to_numpy()
            return out

        for rows, same, _ in _walk(batches, keys):
            start, end = rows.column(keys), rows.column(keys + 1)
            before = pa.chunked_array([pa.nulls(1, end.type) if reach is None else reach])
            s, e, r = _codes(start.cast(end.type), end, before)
            segment = np.concatenate(([0], np.cumsum(~same)))
            lowest = np.iinfo(np.int64).min
            known = _running_max(e, segment)
            ahead = np.concatenate(([lowest], np.where(same, known[:-1], lowest)))
            # ``reach`` is the latest end before the first row of its key; it counts for that whole segment.
            ahead = np.where(segment == 0, np.maximum(ahead, r[0]), ahead)
            touches = (ahead > s)[:-1] | (same & (s[1:] < e[:-1]))
            if in_first:
                touches |= segment[:-1] == 0
            kept = touches & usable(rows)[:-1]
            yield from rows.slice(0, len(rows) - 1).filter(pa.array(kept)).select(range(keys + 2)).combine_chunks().to_batches()
            in_first = in_first and not segment[-1]
            # What reaches into the row that is held.
            tail = np.where((segment == segment[-1]) & (np.arange(len(rows)) < len(rows) - 1), e, lowest)
            latest = int(tail.argmax())
            if segment[-1] or tail[latest] > r[0]:
                reach = end.slice(latest, 1).combine_chunks() if tail[latest] > lowest else None
            last = rows.slice(len(rows) - 1)
        if last is not None:
            yield from last.filter(pa.array(usable(last))).select(range(keys + 2)).combine_chunks().to_batches()

    return run


def touching(df: DataFrame, keys: Sequence[str], start: str, end: str, ordered: Sequence[str]) -> DataFrame:
    """(keys, start, end) of all rows that overlap another one, and of few that do not.

    Rows with a NULL in these are left out. ``ordered`` names the columns of the order after the keys.
    """
    rows = in_order(df.select(*cols([*keys, *ordered])), [*keys, *ordered])
    schema = T.StructType([*_fields(df, keys, "k"), *_fields(df, [start, end], "t")])
    return rows.mapInArrow(_touching(len(keys)), schema).toDF(*keys, start, end)


def _segment_sums(keys: int, schema: pa.Schema):
    """Per partition and segment: sums of ``first`` and ``second``, and over its ordered pairs of their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums, last = TaskContext.get().partitionId(), np.zeros(3, np.int64), None

        def rows_out(rows: pa.Table, values: np.ndarray) -> list[pa.RecordBatch]:
            more = [pa.array(np.full(len(rows), part, np.int64)), *(pa.array(v) for v in values.T)]
            return _batches([*rows.columns[:keys], *more], schema)

        for rows, same, is_first in _walk(batches, keys):
            own = 0 if is_first else 1
            first, second = (rows.column(i).to_numpy()[own:].astype(np.int64) for i in (-2, -1))
            changes = np.concatenate(([False], ~same)) if is_first else ~same
            segment = np.cumsum(changes)
            n = int(segment[-1]) + 1
            begins = np.searchsorted(segment, np.arange(n))
            ahead = np.cumsum(first) - first
            ahead = ahead - np.append(ahead, 0)[begins][segment]
            per = np.zeros((n, 3), np.int64)
            for i, v in enumerate((first, second, second * ahead)):
                np.add.at(per[:, i], segment, v)
            # The segment that was open goes on: its pairs are those of both parts and those across.
            per[0, 2] += sums[2] + sums[0] * per[0, 1]
            per[0, :2] += sums[:2]
            if n > 1:
                at = np.flatnonzero(changes) + own - 1
                yield from rows_out(rows.take(pa.array(at)), per[:-1])
            sums, last = per[-1], rows.slice(len(rows) - 1)
        if last is not None:
            yield from rows_out(last, sums[None, :])

    return run


def ordered_pairs(df: DataFrame, segment: Sequence[str], by: Sequence[str], first: Column, second: Column) -> DataFrame:
    """(segment, total): over all pairs of rows of a segment, x before y in order of ``by``, the sum of first(x) * second(y).

    A segment of any size is spread over partitions; of each part only its sums go on.
    """
    rows = df.select(*cols([*segment, *by]), first.cast("bigint").alias("_first"), second.cast("bigint").alias("_second"))
    schema = T.StructType([*_fields(df, segment, "k"), *_longs(PART, "f", "s", "inner")])
    names = [f"k{i}" for i in range(len(segment))]
    sums = in_order(rows, [*segment, *by]).mapInArrow(_segment_sums(len(segment), _arrow(schema)), schema)
    before = F.sum("f").over(Window.partitionBy(*names).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    pairs = F.col("inner") + F.coalesce(before, F.lit(0)) * F.col("s")
    return sums.withColumn("pairs", pairs).groupBy(*names).agg(F.sum("pairs").alias("total")).toDF(*segment, "total")


def _numbers(keys: int, parts: int, schema: pa.Schema):
    """Rows with their partition and their place among the rows of their key in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, passed = TaskContext.get().partitionId(), -1
        if part >= parts:
            raise RuntimeError(f"partition {part} of {parts}")
        for rows, same, is_first in _walk(batches, keys):
            own = rows if is_first else rows.slice(1)
            changes = np.concatenate(([False], ~same)) if is_first else ~same
            at = np.arange(len(own))
            begin = np.maximum.accumulate(np.where(changes, at, -1))
            place = np.where(begin < 0, passed + 1 + at, at - begin)
            passed = int(place[-1])
            columns = [*own.columns, pa.array(np.full(len(own), part, np.int64)), pa.array(place.astype(np.int64))]
            yield from _batches(columns, schema)

    return run


_LEVEL = ("_level", "_in", "_block")


def dominance_levels(df: DataFrame, keys: Sequence[str], x: str, y: str, is_query: str, weight: str, most: str) -> DataFrame:
    """Rows whose ordered pairs are those of a query and a point of a key with no larger x and no smaller y.

    Columns: keys, a segment in ``_LEVEL``, y, whether the row is a point, weight. Points and queries are sorted by x, a
    point before a query of the same x. The places of a pair differ in one highest bit; at that bit's level the two
    stand in the two halves of one block, and in order of y the query comes first. A block of any size is a segment
    that can be cut into ranges of y. The partitions that a key is spread over are levels above those of places.
    ``most`` bounds the number of a key's points and queries.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*cols([*keys, x, is_query, y, weight, most]))
    schema = T.StructType([*rows.schema.fields, *_longs(PART, "_place")])
    rows = in_order(rows, [*keys, x, is_query], parts).mapInArrow(_numbers(len(keys), parts, _arrow(schema)), schema)
    query = F.col(is_query) == 1

    def levels(at: Column, bits: Column, first: int, part: Column) -> Column:
        """Blocks in whose right half a query stands, or in whose left half a point."""
        wanted = F.when(query, 1).otherwise(0)
        mine = F.filter(F.sequence(F.lit(0), bits - 1), lambda j: F.getbit(at, j) == wanted)
        shifted = lambda j: F.call_function("shiftright", at, j + 1)
        found = F.transform(mine, lambda j: F.struct((j + first).alias("level"), part.alias("part"), shifted(j).alias("block")))
        return F.when(bits > 0, found)

    within = levels(F.col("_place"), F.length(F.bin(most)), 0, F.col(PART))
    over = levels(F.col(PART), F.lit((parts - 1).bit_length()), 64, F.lit(-1).cast("bigint"))
    blocks = F.explode(F.concat(*[F.coalesce(b, F.slice(within, 1, 0)) for b in (within, over)]))
    rows = rows.withColumn("_at", blocks)
    at = [F.col(f"_at.{c}").alias(n) for c, n in zip(("level", "part", "block"), _LEVEL)]
    return rows.select(*cols(keys), *at, col(y), (1 - F.col(is_query)).alias("_point"), col(weight))


def overlap_counts(rows: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """(keys, count) of ordered pairs of overlapping rows of a key, from rows without NULL in key, start and end.

    Two rows do not overlap if one ends before or where the other starts; inverted rows can do both. So the number is
    that of all pairs, less those ordered in time, plus those ordered in both ways, each without pairs of equal starts,
    which never overlap. The first two are counts of one order. Pairs ordered in both ways need a row that does not end
    after it starts, and are counted by dominance for keys that have one.
    """
    k = cols(keys)
    rows = rows.toDF(*keys, "_s", "_e").withColumn("_s", F.col("_s").cast(rows.schema[end].dataType))
    # Equal rows are one row and their number. The counts below all read this exchange, so what is before it runs once.
    rows = rows.groupBy(*k, "_s", "_e").agg(F.count("*").alias("_w"))
    rows = rows.withColumn("_empty", F.when(F.col("_s") < F.col("_e"), 0).otherwise(F.col("_w")).cast("bigint"))
    big = lambda c: c.cast("decimal(38,0)")
    n, z, w = F.col("n"), F.col("z"), F.col("_w")
    per_start = rows.groupBy(*k, "_s").agg(F.sum("_w").alias("n"), F.sum("_empty").alias("z"))
    # Of rows with one start: all pairs, less twice those of an empty row before any other, plus those of two empty rows.
    alike = big(n) * (n - 1) - 2 * big(z) * (n - 1) + big(z) * (z - 1)
    plain = per_start.groupBy(*k).agg(F.sum("n").alias("n"), F.sum("z").alias("z"), F.sum(alike).alias("alike"))
    # An empty row is ordered with itself, in both counts.
    plain = plain.select(*k, (big(n) * (n - 1) - F.col("alike") + 2 * big(z) - z).alias("amount"))
    event = lambda at, kind: F.struct(F.col(at).alias("_at"), F.lit(kind).alias("_kind"))
    events = rows.select(*k, "_w", F.explode(F.array(event("_e", 0), event("_s", 1))).alias("_event")).select(*k, "_w", "_event.*")
    is_empty = F.col("_empty") > 0
    point = F.struct(F.col("_e").alias("_x"), F.lit(0).alias("_query"), F.col("_s").alias("_y"), (2 * w - F.col("_empty")).alias("_weight"))
    query = F.struct(F.col("_s").alias("_x"), F.lit(1).alias("_query"), F.col("_e").alias("_y"), w.alias("_weight"))
    with_empty = rows.groupBy(*k).agg((F.count("*") + F.count_if(is_empty)).alias("_most"), F.max("_empty").alias("_any"))
    both = F.array_compact(F.array(point, F.when(is_empty, query)))
    marks = rows.join(with_empty.where("_any > 0").drop("_any"), list(keys)).select(*k, "_most", F.explode(both).alias("_mark"))
    marks = marks.select(*k, "_most", "_mark.*")
    two_ways = dominance_levels(marks, keys, "_x", "_y", "_query", "_weight", "_most")
    # All segments are summed by one job: the rows in order of time, ends first, and the levels of dominance.
    no_level = [F.lit(v).cast(kind).alias(c) for v, kind, c in zip((-1, 0, 0), ("int", "bigint", "bigint"), _LEVEL)]
    # The levels come first, as their partitions are numbered from zero in a stage that holds both.
    segments = two_ways.toDF(*keys, *_LEVEL, "_at", "_kind", "_w").union(events.select(*k, *no_level, "_at", "_kind", "_w"))
    found = ordered_pairs(segments, [*keys, *_LEVEL], ["_at", "_kind"], (1 - F.col("_kind")) * w, F.col("_kind") * w)
    signed = F.when(F.col("_level") < 0, -2).otherwise(1) * big(F.col("total"))
    amounts = plain.union(found.select(*k, signed))
    counts = amounts.groupBy(*k).agg(F.sum("amount").cast("bigint").alias(COUNT))
    return counts.where(F.col(COUNT) > 0)

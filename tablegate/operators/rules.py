"""Business rules on current records. Every check returns the offending rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.config import ConfigError, ForeignKey, HistorySpec
from tablegate.functions.columns import COUNT, col, cols
from tablegate.operators.history import duplicate_current
from tablegate.sources.tables import current


def is_missing(spec: HistorySpec, column: str) -> Column:
    return col(spec.is_current) & col(column).isNull()


def is_out_of_range(spec: HistorySpec, column: str, low: float | None, high: float | None) -> Column:
    """Outside inclusive bounds, either of which may be open. NULL is inside."""
    sides = []
    if low is not None:
        sides.append(col(column) < F.lit(low))
    if high is not None:
        sides.append(col(column) > F.lit(high))
    if not sides:
        raise ConfigError(f"{column}: a range needs at least one bound")
    outside = sides[0] if len(sides) == 1 else sides[0] | sides[1]
    return col(spec.is_current) & outside


def _tagged(df: DataFrame, spec: HistorySpec, predicates: Mapping[str, Column]) -> DataFrame:
    """(keys, column_name) row for every predicate a row violates, from one scan."""
    hit = F.filter(
        F.array(*[F.when(p, F.lit(n)) for n, p in predicates.items()]), lambda x: x.isNotNull()
    )
    return df.select(*cols(spec.keys), F.explode(hit).alias("column_name"))


def required_fields(df: DataFrame, spec: HistorySpec, columns: Sequence[str]) -> DataFrame:
    """Current rows with NULL in a required column: (keys, column_name)."""
    return _tagged(df, spec, {c: is_missing(spec, c) for c in columns})


def numeric_range(
    df: DataFrame, spec: HistorySpec, column: str, low: float | None, high: float | None
) -> DataFrame:
    """Current rows whose value lies outside the bounds: (keys, column)."""
    out = [*spec.keys, *([] if column in spec.keys else [column])]
    return df.where(is_out_of_range(spec, column, low, high)).select(*cols(out))


def numeric_ranges(
    df: DataFrame, spec: HistorySpec, ranges: Mapping[str, tuple[float | None, float | None]]
) -> DataFrame:
    """Violations of several ranges from one scan: (keys, column_name, value)."""
    hit = F.filter(
        F.array(
            *[
                F.when(
                    is_out_of_range(spec, c, low, high),
                    F.struct(F.lit(c).alias("column_name"), col(c).cast("double").alias("value")),
                )
                for c, (low, high) in ranges.items()
            ]
        ),
        lambda x: x.isNotNull(),
    )
    return df.select(*cols(spec.keys), F.explode(hit).alias("_hit")).select(
        *cols(spec.keys), "_hit.column_name", "_hit.value"
    )


def dangling_values(
    child: DataFrame, parent: DataFrame, spec: HistorySpec, fk: ForeignKey, parent_spec: HistorySpec
) -> DataFrame:
    """(value, count): referencing values without a current parent, and the rows that hold them.

    Both sides are reduced to distinct values first, so a value shared by many rows is one row
    by the time it is shuffled and joined.
    """
    used = (
        current(child, spec)
        .where(col(fk.column).isNotNull())
        .groupBy(col(fk.column).alias("_value"))
        .agg(F.count("*").alias(COUNT))
    )
    known = current(parent, parent_spec).select(col(fk.ref_column).alias("_known")).distinct()
    # The count in the condition keeps the join above the counting.
    missing = (F.col("_value") == F.col("_known")) & (F.col(COUNT) > 0)
    return used.join(known, missing, "left_anti").select("_value", COUNT)


def foreign_key(
    child: DataFrame, parent: DataFrame, spec: HistorySpec, fk: ForeignKey, parent_spec: HistorySpec
) -> DataFrame:
    """Current rows whose reference has no current parent: (keys, reference). NULL passes.

    Rows are picked by the set of dangling values. The hash in the join condition makes the
    planner exchange that set for the join, which the partitioning of its anti-join would
    otherwise spare. Its real size is thus known at run time: the adaptive planner broadcasts
    it if it is small, and else has two exchanged sides and splits a skewed reference.
    """
    dangling = dangling_values(child, parent, spec, fk, parent_spec).select(
        "_value", F.xxhash64("_value").alias("_hash")
    )
    out = [*spec.keys, *([] if fk.column in spec.keys else [fk.column])]
    rows = current(child, spec).select(*cols(out))
    match = (F.xxhash64(col(fk.column)) == F.col("_hash")) & (col(fk.column) == F.col("_value"))
    return rows.join(dangling, match, "left_semi")


def conditional_rule(df: DataFrame, spec: HistorySpec, predicate: str) -> DataFrame:
    """Rows matching a SQL predicate that should match none.

    The predicate is taken as it is and has to ask for current rows itself.
    """
    return df.where(F.expr(f"({predicate})")).select(*cols(spec.keys))


def duplicate_keys(df: DataFrame, spec: HistorySpec) -> DataFrame:
    """Business keys shared by several current records, with their number."""
    return duplicate_current(df, spec)

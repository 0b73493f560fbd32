"""Comparison of an expected with an actual aggregate, in the DOUBLE domain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def side_values(frame: DataFrame, metrics: Sequence[str], side: str) -> DataFrame:
    """One-row aggregate frame -> (metric, expected, actual) rows with the other side NULL."""
    value = F.col("value").cast("double")
    none = F.lit(None).cast("double")
    wide = frame.select(*[F.col(f"`{m}`").cast("double").alias(m) for m in metrics])
    return wide.unpivot([], list(metrics), "metric", "value").select(
        "metric",
        (value if side == "expected" else none).alias("expected_value"),
        (value if side == "actual" else none).alias("actual_value"),
    )


def paired(expected: DataFrame, actual: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Line up two one-row aggregate frames as (metric, expected, actual, variance, pct) rows.

    A zero base gives a percentage of 0.
    """
    both = side_values(expected, metrics, "expected").unionByName(side_values(actual, metrics, "actual"))
    rows = both.groupBy("metric").agg(
        F.max("expected_value").alias("expected_value"), F.max("actual_value").alias("actual_value")
    )
    variance = F.col("actual_value") - F.col("expected_value")
    return rows.select(
        "metric",
        "expected_value",
        "actual_value",
        variance.alias("variance_value"),
        percent_of(variance, F.col("expected_value")).alias("variance_pct"),
    )


def percent_of(part: Column, base: Column) -> Column:
    return F.when(base == 0, F.lit(0.0)).otherwise(part / F.nullif(base, F.lit(0.0)) * 100)


def off_zero_base() -> Column:
    """True where the base is zero but the other side is not."""
    return (F.col("expected_value") == 0) & (F.col("actual_value") != 0)

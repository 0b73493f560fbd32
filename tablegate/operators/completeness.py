"""Completeness of the curated layer against one batch of the raw layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.config import SUM_TOLERANCE_PCT, HistorySpec, Status
from tablegate.functions.columns import COUNT, col, cols, repeat_rows
from tablegate.functions.compare import off_zero_base, paired
from tablegate.functions.sums import steady_sum
from tablegate.sources.shared import checkpointed, has_shared_folder
from tablegate.sources.tables import batch_slice

#: Distinct keys of a batch that are sent to every task.
BROADCAST_KEYS = 100_000
_ROWS = "_rows"
_RECON_COLUMNS = ("expected_value", "actual_value", "variance_value", "variance_pct")


def _batch_totals(
    raw: DataFrame, curated: DataFrame, spec: HistorySpec, raw_batch: str, batch_id: str, columns: Sequence[str]
) -> DataFrame:
    """Row counts and column sums of both sides, each side in one pass.

    Counts take every curated version the batch wrote, sums only the current ones. Sums of doubles do not depend on the
    order of the rows.
    """
    live = col(spec.is_current)
    raw_sums = [steady_sum(raw, c).alias(c) for c in columns]
    curated_sums = [steady_sum(curated, c, live).alias(c) for c in columns]
    rows = F.count("*").cast("double").alias(_ROWS)
    expected = batch_slice(raw, raw_batch, batch_id).agg(rows, *raw_sums)
    actual = batch_slice(curated, spec.batch, batch_id).agg(rows, *curated_sums)
    return paired(expected, actual, [_ROWS, *columns])


def _passed(metric, zero_base: bool):
    within = F.abs("variance_pct") < SUM_TOLERANCE_PCT
    if zero_base:
        within = within & ~off_zero_base()
    return F.when(metric == _ROWS, F.col("variance_value") == 0).otherwise(within)


def batch_recon(
    raw: DataFrame,
    curated: DataFrame,
    spec: HistorySpec,
    batch_id: str,
    columns: Sequence[str] = (),
    raw_batch: str = "_batch_id",
    strict_zero_base: bool = False,
) -> DataFrame:
    """Result rows of the row count and of every column sum.

    ``metric`` is NULL for the row count. The count must agree exactly, a sum to within the
    fixed tolerance. A zero base counts as no deviation unless ``strict_zero_base``.
    """
    totals = _batch_totals(raw, curated, spec, raw_batch, batch_id, columns)
    metric = F.col("metric")
    is_rows = metric == _ROWS
    return totals.select(
        F.when(~is_rows, metric).alias("metric"),
        *_RECON_COLUMNS,
        F.when(_passed(metric, strict_zero_base), Status.PASS.value).otherwise(Status.FAIL.value).alias("status"),
        F.when(is_rows, F.abs("variance_value").cast("bigint")).alias("failure_count"),
    )


def row_count_recon(
    raw: DataFrame, curated: DataFrame, spec: HistorySpec, batch_id: str, raw_batch: str = "_batch_id"
) -> DataFrame:
    """Rows of the batch in the raw table against rows the batch wrote to the curated one."""
    found = batch_recon(raw, curated, spec, batch_id, (), raw_batch)
    return found.select(
        F.lit("row_count").alias("check_name"), *_RECON_COLUMNS, "status", "failure_count"
    )


def numeric_sum_recon(
    raw: DataFrame,
    curated: DataFrame,
    spec: HistorySpec,
    batch_id: str,
    columns: Sequence[str],
    raw_batch: str = "_batch_id",
    strict_zero_base: bool = False,
) -> DataFrame:
    """Column sums of the batch in the raw table against those of its current curated rows."""
    found = batch_recon(raw, curated, spec, batch_id, columns, raw_batch, strict_zero_base)
    return found.where(F.col("metric").isNotNull()).select(
        F.concat(F.lit("numeric_sum_"), "metric").alias("check_name"), *_RECON_COLUMNS, "status"
    )


def missing_keys(
    raw: DataFrame, curated: DataFrame, spec: HistorySpec, batch_id: str, raw_batch: str = "_batch_id"
) -> DataFrame:
    """``key_coverage`` with the rows of a key merged into one row and their number.

    The distinct keys of the batch come first, and are stored if the session has a folder for it, so the batch is read
    once. Their number and the range of each key column are one row for the driver. Curated keys outside the ranges
    cannot be in the batch: the scan leaves their row groups out, whatever the size of the batch. If the keys are few
    they also go to every task that reads curated keys, so only keys of the batch are shuffled; else both sides are
    reduced to distinct keys before their shuffle. The count in the join condition keeps the join above the counting,
    so a key in a third of the batch is one row by then.
    """
    keys = cols(spec.keys)
    wanted = batch_slice(raw, raw_batch, batch_id).groupBy(*keys).agg(F.count("*").alias(COUNT))
    if has_shared_folder(raw.sparkSession):
        wanted = checkpointed(wanted)
    ends = [F.struct(F.min(k).alias("low"), F.max(k).alias("high")).alias(f"_range_{i}") for i, k in enumerate(keys)]
    *ranges, size = wanted.agg(*ends, F.count("*")).first()
    names = [f"_key_{i}" for i in range(len(spec.keys))]
    present = curated.select(*keys)
    for key, found in zip(keys, ranges):
        if found["low"] is not None:
            present = present.where((key >= F.lit(found["low"])) & (key <= F.lit(found["high"])))
    if size <= BROADCAST_KEYS:
        present = present.join(F.broadcast(wanted.select(*keys)), list(spec.keys), "left_semi")
    present = present.distinct().toDF(*names)
    same = [col(k) == F.col(n) for k, n in zip(spec.keys, names)]
    return wanted.join(present, [*same, F.col(COUNT) > 0], "left_anti").select(*keys, F.col(COUNT))


def key_coverage(
    raw: DataFrame, curated: DataFrame, spec: HistorySpec, batch_id: str, raw_batch: str = "_batch_id"
) -> DataFrame:
    """Raw rows of the batch whose key occurs in no curated row. A NULL key never occurs."""
    return repeat_rows(missing_keys(raw, curated, spec, batch_id, raw_batch))

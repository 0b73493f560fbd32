"""Samples of failing keys and summaries of result rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.config import SAMPLE_SIZE, Status
from tablegate.functions.columns import COUNT
from tablegate.sources.shared import find_package


def lowest(rows: DataFrame, group: str, by: str, n: int) -> DataFrame:
    """Of each partition the ``n`` rows of each group with the smallest text in ``by``, kept while rows pass by.

    Nothing is shuffled or sorted; what is kept of two partitions can be cut again.
    """
    find_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, pa.Table] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for name in pc.unique(table[group]).to_pylist():
                found = table.filter(pc.equal(table[group], name))
                if name in kept:
                    found = pa.concat_tables([kept[name], found])
                if len(found) > n:
                    found = found.take(pc.select_k_unstable(found, n, [(by, "ascending")]))
                kept[name] = found.combine_chunks()
        for found in kept.values():
            yield from found.to_batches()

    return rows.mapInArrow(run, rows.schema)


def failure_sample(tagged: DataFrame, n: int = SAMPLE_SIZE) -> DataFrame:
    """(check_name, failure_sample): JSON array of the first ``n`` keys in text order.

    ``tagged`` holds (check_name, key_json, count). At most ``n`` rows per check and task are exchanged and held.
    """
    first = lowest(tagged, "check_name", "key_json", n)
    first = lowest(first.repartition("check_name"), "check_name", "key_json", n)
    copies = F.array_repeat("key_json", F.least(F.col(COUNT), F.lit(n)).cast("int"))
    picked = F.slice(F.sort_array(F.flatten(F.collect_list(copies))), 1, n)
    return first.groupBy("check_name").agg(
        F.concat(F.lit("["), F.array_join(picked, ","), F.lit("]")).alias("failure_sample")
    )


def run_summary(checks: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Overall status and counts of every run: FAIL before WARN before PASS."""
    counts = checks.groupBy(*by).agg(
        F.count("*").alias("total_checks"),
        *[
            F.count_if(F.col("status") == status.value).alias(name)
            for status, name in (
                (Status.PASS, "passed_checks"),
                (Status.FAIL, "failed_checks"),
                (Status.WARN, "warned_checks"),
            )
        ],
    )
    status = (
        F.when(F.col("failed_checks") > 0, Status.FAIL.value)
        .when(F.col("warned_checks") > 0, Status.WARN.value)
        .otherwise(Status.PASS.value)
    )
    return counts.select(
        *by, status.alias("status"), "total_checks", "passed_checks", "failed_checks", "warned_checks"
    )


def overall(statuses: Sequence[str]) -> Status:
    """The same verdict over statuses already on the driver; PASS when there are none."""
    seen = set(statuses)
    return Status.FAIL if "FAIL" in seen else Status.WARN if "WARN" in seen else Status.PASS

"""Helpers of the corpus operators: stored tables, linked groups, sorted streams."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.sources.shared import shared_folder

#: Ids that are sent to every task; above it, joins shuffle both sides.
BROADCAST_ROWS = 1_000_000
#: Bytes of rows that Python workers get at once, which is the most that any step keeps together.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where it lies, whatever folder the driver was started in."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join([root, known] if known else [root])


def short_batches(spark: SparkSession) -> None:
    """Let Spark hand rows to Python workers in batches of ``BATCH_BYTES``, unless the session has a limit of its own.

    By default a batch has 10,000 rows or 64 MB, whichever comes first. For whole texts that is mostly all of a task's
    input, and the executor and the worker each hold it several times over; no step needs more than a part of it.
    The limit stays with the session, as Spark reads it when a result is computed.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, so later steps do not depend on how it was made."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once for each row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def with_ids(rows: DataFrame, ids: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Rows joined to a stored table of ids; the ids go to every task only if they are counted to be few."""
    few = ids.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(ids) if few else ids, key, how)


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches cut to ``rows``, for steps that hold several times a batch's texts."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def few_bytes(batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` holds at most ``size`` bytes, or a single row."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def split_by(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table for each value of ``keys`` in a stream that is sorted by them. Only one group is in memory."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns, strict=True))
        start = 0
        for i, row in enumerate(rows):
            if row != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, row
        if start < len(rows):
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame) -> DataFrame:
    """Connected groups of an undirected graph: ``edges`` (a, b) to (node, root).

    ``root`` is the smallest node of the group. Nodes without an edge to another node are left out. Each round links
    the neighbours of every node to its smallest one; rounds grow with the logarithm of a group's length.
    Minima are merged before shuffles, so a node with very many edges costs one row a task; the joins that follow
    can be split. The graph lives in tables, never on the driver.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = _state(links)
    while state[0]:
        both = links.union(links.select("b", "a"))
        small = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        links = both.join(small, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        links = stored(links.where("a <> b"))
        small = links.groupBy("a").agg(F.min("b").alias("m"))
        step = links.join(small, "a")
        links = step.select(F.col("b").alias("a"), F.col("m").alias("b")).union(step.select("a", "m"))
        links = stored(links.where("a <> b").distinct())
        now = _state(links)
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _state(links: DataFrame) -> tuple:
    """What tells two sets of links apart."""
    both = F.xxhash64("a", "b")
    sums = [F.sum(F.pmod(both, F.lit(p))) for p in (2147483647, 2147483629)]
    return tuple(links.agg(F.count("*"), *sums).first())

"""Table access: scans of the raw and curated layers and reads of the source system."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.config import ConfigError, HistorySpec
from tablegate.functions.columns import col


def batch_slice(df: DataFrame, batch_col: str, batch_id: str) -> DataFrame:
    """Rows that one ingestion batch wrote; a literal filter, so partitions are pruned on it."""
    return df.where(col(batch_col) == F.lit(batch_id))


def current(df: DataFrame, spec: HistorySpec) -> DataFrame:
    """Current versions only. A NULL flag is not current."""
    return df.where(col(spec.is_current))


class Source(Protocol):
    """A source system that can evaluate aggregates over one of its tables."""

    def aggregate(self, table: str, expressions: Mapping[str, str]) -> DataFrame:
        """One row with a column per name in ``expressions``."""
        ...


@dataclass(frozen=True)
class FrameSource:
    """Source tables that Spark can read itself."""

    frames: Mapping[str, DataFrame]

    def aggregate(self, table: str, expressions: Mapping[str, str]) -> DataFrame:
        if table not in self.frames:
            raise ConfigError(f"source table {table!r} is not available")
        return self.frames[table].agg(*[F.expr(e).alias(n) for n, e in expressions.items()])


@dataclass(frozen=True)
class JdbcSource:
    """Source tables behind JDBC: all aggregates of a table run there as one query."""

    spark: SparkSession
    options: Mapping[str, str] = field(repr=False)

    def query(self, table: str, expressions: Mapping[str, str]) -> str:
        return f"SELECT {', '.join(f'{e} AS {n}' for n, e in expressions.items())} FROM {table}"

    def aggregate(self, table: str, expressions: Mapping[str, str]) -> DataFrame:
        return read_source(self.spark, self.options, self.query(table, expressions))


def read_source(spark: SparkSession, options: Mapping[str, str], query: str) -> DataFrame:
    """Run ``query`` at the source system and return its result."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()


class Tables(Protocol):
    """Where the raw and curated tables come from."""

    def raw(self, name: str) -> DataFrame: ...

    def curated(self, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class FrameTables:
    """Tables handed in as DataFrames."""

    raw_frames: Mapping[str, DataFrame]
    curated_frames: Mapping[str, DataFrame]

    def raw(self, name: str) -> DataFrame:
        return self._get(self.raw_frames, name)

    def curated(self, name: str) -> DataFrame:
        return self._get(self.curated_frames, name)

    @staticmethod
    def _get(frames: Mapping[str, DataFrame], name: str) -> DataFrame:
        if name not in frames:
            raise ConfigError(f"table {name!r} is not available")
        return frames[name]


@dataclass(frozen=True)
class CatalogTables:
    """Tables addressed as ``[catalog.]schema.table``."""

    spark: SparkSession
    raw_schema: str
    curated_schema: str
    catalog: str | None = None

    def raw(self, name: str) -> DataFrame:
        return self.spark.table(self._path(self.raw_schema, name))

    def curated(self, name: str) -> DataFrame:
        return self.spark.table(self._path(self.curated_schema, name))

    def _path(self, schema: str, name: str) -> str:
        parts = [p for p in (self.catalog, schema, name) if p]
        return ".".join("`" + p.replace("`", "``") + "`" for p in parts)

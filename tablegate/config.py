"""Declarative description of the tables to validate.

Everything here is plain frozen data; no Spark session is needed to build or check a registry.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from enum import Enum

# These strings are stored in the log and read by its consumers.


class Status(str, Enum):
    PASS = "PASS"
    FAIL = "FAIL"
    WARN = "WARN"
    RUNNING = "RUNNING"
    ERROR = "ERROR"


class Severity(str, Enum):
    BLOCKING = "BLOCKING"
    WARNING = "WARNING"
    INFO = "INFO"


class Category(str, Enum):
    COMPLETENESS = "COMPLETENESS"
    SCD2 = "SCD2"
    BUSINESS_RULE = "BUSINESS_RULE"
    SOURCE_RECON = "SOURCE_RECON"


@dataclass(frozen=True)
class Tier:
    number: int
    name: str
    category: Category
    severity: Severity

    @property
    def failed_status(self) -> Status:
        """Status of a check that found violations in this tier."""
        return Status.FAIL if self.severity is Severity.BLOCKING else Status.WARN


COMPLETENESS = Tier(1, "Completeness", Category.COMPLETENESS, Severity.BLOCKING)
HISTORY = Tier(2, "SCD2 Integrity", Category.SCD2, Severity.BLOCKING)
RULES = Tier(3, "Business Rules", Category.BUSINESS_RULE, Severity.WARNING)
RECON = Tier(4, "Source Reconciliation", Category.SOURCE_RECON, Severity.WARNING)
TIERS = {t.number: t for t in (COMPLETENESS, HISTORY, RULES, RECON)}

# Percent by which a curated sum may differ from the raw sum, exclusive.
SUM_TOLERANCE_PCT = 0.001
DEFAULT_RECON_THRESHOLD_PCT = 1.0
SAMPLE_SIZE = 10


class ConfigError(ValueError):
    """A registry entry or argument that cannot be validated against."""


@dataclass(frozen=True)
class HistorySpec:
    """Names of the columns that make a table a version history."""

    keys: tuple[str, ...]
    is_current: str = "is_current"
    start: str = "effective_start_date"
    end: str = "effective_end_date"
    batch: str = "_batch_id"

    def __post_init__(self) -> None:
        keys = (self.keys,) if isinstance(self.keys, str) else tuple(self.keys)
        if not keys or len(set(keys)) != len(keys):
            raise ConfigError(f"business key must name distinct columns, got {keys!r}")
        object.__setattr__(self, "keys", keys)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    ref_table: str
    ref_column: str


@dataclass(frozen=True)
class Metric:
    """One aggregate to compare: a SQL expression per side."""

    name: str
    source_expr: str
    curated_expr: str


@dataclass(frozen=True)
class TableSpec:
    """Everything the four tiers need to know about one curated table."""

    name: str
    history: HistorySpec
    raw_table: str | None = None
    raw_batch: str = "_batch_id"
    sum_columns: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()
    rules: Mapping[str, str] = field(default_factory=dict)
    duplicate_rule: bool = False
    source_table: str | None = None
    metrics: tuple[Metric, ...] = ()

    def __post_init__(self) -> None:
        for column, (low, high) in self.ranges.items():
            if low is None and high is None:
                raise ConfigError(f"{self.name}.{column}: a range needs at least one bound")
        if self.metrics and self.source_table is None:
            raise ConfigError(f"{self.name}: metrics need a source_table")

    @property
    def keys(self) -> tuple[str, ...]:
        return self.history.keys


class Registry:
    """Ordered, named collection of table specs."""

    def __init__(self, tables: Iterable[TableSpec]):
        self._tables = {t.name: t for t in tables}

    def __iter__(self):
        return iter(self._tables.values())

    def __len__(self) -> int:
        return len(self._tables)

    def __getitem__(self, name: str) -> TableSpec:
        try:
            return self._tables[name]
        except KeyError:
            raise ConfigError(f"unknown table {name!r}; known: {sorted(self._tables)}") from None

    def select(self, tables: Iterable[str] | str | None = None) -> list[TableSpec]:
        """Specs of the named tables; all of them when nothing is named."""
        if not tables:
            return list(self._tables.values())
        names = [tables] if isinstance(tables, str) else list(tables)
        return [self[n] for n in names]

    def override(self, name: str, **changes) -> Registry:
        return Registry(replace(t, **changes) if t.name == name else t for t in self)

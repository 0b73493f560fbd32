"""Run the tiers in order, log what they find and stop when a blocking tier does not pass.

Only result rows reach the driver, one per check and a sample of at most ten keys for those
that failed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from tablegate import log as store
from tablegate.config import (
    COMPLETENESS,
    DEFAULT_RECON_THRESHOLD_PCT,
    HISTORY,
    RECON,
    RULES,
    ConfigError,
    Registry,
    Status,
    TableSpec,
    Tier,
)
from tablegate.gate import PipelineBlocked
from tablegate.plans import checks as plan
from tablegate.plans.results import failure_sample, overall
from tablegate.sources.tables import Source, Tables


@dataclass(frozen=True)
class RunOptions:
    batch_id: str = ""
    pipeline_run_id: str = ""
    tables: Iterable[str] | str | None = None
    run_recon: bool = False
    threshold_pct: float = DEFAULT_RECON_THRESHOLD_PCT
    strict_zero_base: bool = False
    run_by: str = ""
    env: str = "dev"
    parallel_jobs: int = 4

    def __post_init__(self) -> None:
        # Names may come from a generator, and every tier reads them again.
        if self.tables is not None and not isinstance(self.tables, str):
            object.__setattr__(self, "tables", tuple(self.tables))


@dataclass
class CheckRow:
    """One row of the check log, without the columns all rows of a run share."""

    check: plan.Check
    status: str
    expected_value: float | None = None
    actual_value: float | None = None
    variance_value: float | None = None
    variance_pct: float | None = None
    failure_count: int | None = None
    failure_sample: str | None = None
    error: str | None = None
    execution_ms: int = 0
    checked_at: datetime = field(default_factory=lambda: _now())


@dataclass(frozen=True)
class TierOutcome:
    tier: Tier
    run_id: str
    status: Status
    rows: list[CheckRow]

    @property
    def passed(self) -> bool:
        return self.status is Status.PASS


@dataclass(frozen=True)
class PipelineOutcome:
    batch_id: str
    pipeline_run_id: str
    completed_at: datetime
    tiers: list[TierOutcome]

    def passed(self, tier: Tier) -> bool:
        """A tier that did not run has passed only if it is the optional one."""
        ran = [t for t in self.tiers if t.tier == tier]
        return ran[0].passed if ran else tier == RECON

    @property
    def overall_pass(self) -> bool:
        return self.passed(COMPLETENESS) and self.passed(HISTORY)


def _now() -> datetime:
    return datetime.now(timezone.utc)


class Pipeline:
    """Everything a validation run needs besides its options."""

    def __init__(
        self,
        spark: SparkSession,
        registry: Registry,
        tables: Tables,
        log: store.ValidationLog,
        source: Source | None = None,
    ):
        self.spark = spark
        self.registry = registry
        self.tables = tables
        self.log = log
        self.source = source

    def run(self, options: RunOptions) -> PipelineOutcome:
        """Run all tiers. Raises ``PipelineBlocked`` right after a blocking tier not passed."""
        self.registry.select(options.tables)
        if options.run_recon and self.source is None:
            raise ConfigError("source reconciliation needs a source")
        self.log.ensure()
        outcomes = []
        for tier in (COMPLETENESS, HISTORY, RULES, *([RECON] if options.run_recon else [])):
            outcome = self.run_tier(tier, options)
            outcomes.append(outcome)
            if tier in (COMPLETENESS, HISTORY) and not outcome.passed:
                raise PipelineBlocked(
                    f"tier {tier.number} ({tier.name}) ended {outcome.status.value} "
                    f"for batch {options.batch_id!r}, run {outcome.run_id}"
                )
        return PipelineOutcome(options.batch_id, options.pipeline_run_id, _now(), outcomes)

    def run_tier(self, tier: Tier, options: RunOptions) -> TierOutcome:
        """Run one tier over the selected tables and log it."""
        specs = self.registry.select(options.tables)
        run = _Run(self, tier, options)
        run.log_run(Status.RUNNING)
        rows: list[CheckRow] = []
        logging = False
        try:
            for spec in specs:
                rows += self._run_table(tier, spec, options)
            logging = True
            run.log_checks(rows)
            if tier == RECON:
                run.log_snapshots(rows)
        except Exception as e:
            # An append that failed may have been done all the same, so it is never tried twice in a run.
            if not logging:
                run.log_checks(rows, quiet=True)
            run.log_run(Status.ERROR, rows, str(e))
            raise
        status = overall([r.status for r in rows])
        if tier in (COMPLETENESS, HISTORY) and not rows:
            status = Status.FAIL  # nothing was checked
        run.log_run(status, rows)
        return TierOutcome(tier, run.run_id, status, rows)

    def groups(self, tier: Tier, spec: TableSpec, options: RunOptions) -> list[plan.Group]:
        if tier == COMPLETENESS:
            return plan.completeness_groups(spec, self.tables, options.batch_id, options.strict_zero_base)
        if tier == HISTORY:
            return plan.history_groups(spec, self.tables)
        if tier == RULES:
            return plan.rule_groups(spec, self.tables, self.registry.__getitem__)
        if not spec.metrics:
            return []
        return plan.recon_groups(
            spec, self.tables, self.source, options.threshold_pct, options.strict_zero_base
        )

    def _run_table(self, tier: Tier, spec: TableSpec, options: RunOptions) -> list[CheckRow]:
        groups = self.groups(tier, spec, options)
        done = self._each(groups, _run_group, options)
        rows = [r for found in done for r in found]
        failing = {
            r.check.full_name: r for r in rows if r.error is None and r.status != Status.PASS.value
        }
        sampled = [g for g in groups if any(c.full_name in failing for c in g.checks)]

        def sample(group: plan.Group) -> dict[str, str]:
            tagged = plan.offenders([group], list(failing))
            if tagged is None:
                return {}
            return {r["check_name"]: r["failure_sample"] for r in failure_sample(tagged).collect()}

        for found in self._each(sampled, _guarded(sample), options):
            for name, text in found.items():
                failing[name].failure_sample = text
        return rows

    def _each(self, items: Sequence, work, options: RunOptions) -> list:
        """Results of ``work`` on each item, with a few Spark jobs in flight at a time."""
        if not items:
            return []
        work = inheritable_thread_target(self.spark)(work)
        with ThreadPoolExecutor(max(1, options.parallel_jobs)) as pool:
            return list(pool.map(work, items))


def _guarded(sample):
    """A sample is a help for reading the log; failing to take one must not fail the check."""

    def attempt(group: plan.Group) -> dict[str, str]:
        try:
            return sample(group)
        except Exception:
            return {}

    return attempt


def _run_group(group: plan.Group) -> list[CheckRow]:
    """Result rows of a group. If it fails as a whole its checks are run one by one, so that
    only those at fault are reported as failed."""
    started = time.monotonic()
    try:
        found = {r["check_name"]: r for r in group.results().collect()}
    except Exception as e:
        if len(group.checks) > 1:
            return [row for part in group.split() for row in _run_group(part)]
        took = int((time.monotonic() - started) * 1000)
        return [CheckRow(group.checks[0], Status.FAIL.value, error=str(e), execution_ms=took)]
    took = int((time.monotonic() - started) * 1000)
    return [
        CheckRow(
            check,
            *[found[check.full_name][c] for c in plan.RESULT_COLUMNS[1:]],
            execution_ms=took,
        )
        for check in group.checks
    ]


class _Run:
    """Log rows of one tier run."""

    def __init__(self, pipeline: Pipeline, tier: Tier, options: RunOptions):
        self.spark = pipeline.spark
        self.log = pipeline.log
        self.tier = tier
        self.options = options
        self.run_id = str(uuid.uuid4())
        self.started_at = _now()
        names = options.tables
        self.table_name = names if isinstance(names, str) and names else ",".join(names or ()) or "ALL"

    def _row_id(self, row: CheckRow) -> str:
        """The same for a check of a run, however often its row is made."""
        return str(uuid.uuid5(uuid.UUID(self.run_id), row.check.full_name))

    def log_run(self, status: Status, rows: Sequence[CheckRow] = (), error: str | None = None) -> None:
        running = status is Status.RUNNING
        counts = [None] * 4
        if not running:
            counts = [len(rows)] + [
                sum(r.status == s.value for r in rows) for s in (Status.PASS, Status.FAIL, Status.WARN)
            ]
        o = self.options
        row = (
            self.run_id,
            o.pipeline_run_id,
            o.batch_id,
            self.table_name,
            self.tier.number,
            self.tier.name,
            self.started_at,
            None if running else _now(),
            status.value,
            *counts,
            error,
            o.run_by,
            o.env,
        )
        self._write(store.RUN, store.RUN_COLUMNS, [row])

    def log_checks(self, rows: Sequence[CheckRow], quiet: bool = False) -> None:
        made = [
            (
                self._row_id(r),
                self.run_id,
                self.options.pipeline_run_id,
                self.options.batch_id,
                r.checked_at,
                self.tier.number,
                self.tier.name,
                r.check.table,
                r.check.full_name,
                self.tier.category.value,
                r.check.description,
                r.status,
                self.tier.severity.value,
                r.expected_value,
                r.actual_value,
                r.variance_value,
                r.variance_pct,
                r.failure_count,
                r.failure_sample,
                r.check.sql if r.error is None else f"ERROR: {r.error}",
                r.execution_ms,
            )
            for r in rows
        ]
        try:
            self._write(store.CHECK, store.CHECK_COLUMNS, made)
        except Exception:
            if not quiet:
                raise

    def log_snapshots(self, rows: Sequence[CheckRow]) -> None:
        made = [
            (
                self._row_id(r),
                self.run_id,
                self.started_at.date(),
                r.check.table,
                r.check.extra[0],
                r.expected_value,
                r.actual_value,
                r.variance_value,
                r.variance_pct,
                r.status == Status.PASS.value,
                float(self.options.threshold_pct),
            )
            for r in rows
            if r.error is None
        ]
        self._write(store.SNAPSHOT, store.SNAPSHOT_COLUMNS, made)

    def _write(self, table: store.LogTable, columns: str, rows: list[tuple]) -> None:
        if rows:
            schema = " ".join(columns.split())
            self.log.write(table, self.spark.createDataFrame(rows, schema).coalesce(1))

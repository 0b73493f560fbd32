"""The gate: the completeness and history tiers must pass before anything downstream runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.config import COMPLETENESS, HISTORY, RECON, RULES, Status


#: What tells which of several runs is the last; rows without such columns count as one run.
_ORDER = {"started_at": "timestamp", "completed_at": "timestamp", "run_id": "string"}
VERDICTS = ("tier1_pass", "tier2_pass", "tier3_pass", "tier4_pass", "overall_pass")


class PipelineBlocked(RuntimeError):
    """A blocking tier did not pass."""


def _passed(tier: int, default: bool):
    """Verdict of the tier's last run. A run's end comes after its start, a rerun after the run before."""
    last = F.struct(*_ORDER)
    of_tier = F.when(F.col("tier") == tier, F.col("status") == Status.PASS.value)
    verdict = F.max_by(of_tier, F.when(F.col("tier") == tier, last))
    return F.coalesce(verdict, F.lit(default))


def pipeline_gate(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Verdict per tier and overall over rows of the run log, for the last pipeline run of each group.

    The last run of a tier decides, so a rerun that passes opens the gate; a run that has only been
    opened has not passed. A tier passes only with status PASS. A blocking tier without a run has
    not passed; the source reconciliation is optional and passes if it was not run. Rules and
    reconciliation do not count for the overall verdict.
    """
    missing = {c: F.lit(None).cast(kind) for c, kind in _ORDER.items() if c not in runs.columns}
    runs = runs.withColumns(missing | ({} if "pipeline_run_id" in runs.columns else {"pipeline_run_id": F.lit("")}))
    first, second = _passed(COMPLETENESS.number, False), _passed(HISTORY.number, False)
    each = runs.groupBy(*by, F.col("pipeline_run_id").alias("_pipeline")).agg(
        F.struct(
            first.alias("tier1_pass"),
            second.alias("tier2_pass"),
            _passed(RULES.number, False).alias("tier3_pass"),
            _passed(RECON.number, True).alias("tier4_pass"),
            (first & second).alias("overall_pass"),
        ).alias("_verdict"),
        F.max(F.struct("started_at", "run_id")).alias("_at"),
    )
    last = each.groupBy(*by).agg(F.max_by("_verdict", "_at").alias("_verdict"))
    return last.select(*by, *[F.coalesce(f"_verdict.{c}", F.lit(c == "tier4_pass")).alias(c) for c in VERDICTS])


def enforce_gate(runs: DataFrame) -> None:
    """Raise unless the blocking tiers of the last pipeline run passed."""
    verdict = pipeline_gate(runs).first()
    if not verdict["overall_pass"]:
        failed = [n for n in ("tier1_pass", "tier2_pass") if not verdict[n]]
        raise PipelineBlocked(f"blocking tiers did not pass: {', '.join(failed)}")

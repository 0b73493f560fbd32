"""Checks of a table grouped into as few Spark jobs as their semantics allow.

A group computes the result rows of one or more checks and can list the keys that failed
them. Groups do nothing until asked and hold no results. Tables are looked up when a group runs,
so a missing one fails the checks that need it and no others. The names of the checks are fixed
values: readers of the log know them.

* Row predicates of a table are counted together in one aggregation without a shuffle.
* History checks are counted in one pass over the versions in order, with one shuffle by key.
* Reconciliations read each side once for all their metrics.
* Checks that need a join, and overlaps, have a plan of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.config import (
    COMPLETENESS,
    HISTORY,
    RECON,
    RULES,
    SAMPLE_SIZE,
    ConfigError,
    ForeignKey,
    HistorySpec,
    Status,
    TableSpec,
    Tier,
)
from tablegate.functions.columns import COUNT, col, cols
from tablegate.operators import completeness, history, recon, rules
from tablegate.plans.results import lowest
from tablegate.sources.tables import Source, Tables

RESULT_COLUMNS = (
    "check_name",
    "status",
    "expected_value",
    "actual_value",
    "variance_value",
    "variance_pct",
    "failure_count",
)


@dataclass(frozen=True)
class Check:
    """Identity of one check and, for predicate checks, what it counts."""

    name: str
    table: str
    tier: Tier
    description: str
    sql: str = ""
    predicate: Column | None = None
    extra: tuple[str, ...] = ()

    @property
    def full_name(self) -> str:
        return f"{self.table}.{self.name}"


@dataclass(frozen=True)
class Group:
    """Base of all groups: a set of checks of one table computed together."""

    checks: tuple[Check, ...]

    def results(self) -> DataFrame:
        raise NotImplementedError

    def offenders(self, names: Sequence[str]) -> DataFrame | None:
        """(check_name, key_json, count) of the first failing keys of each task, or None if the checks have no keys."""
        return None

    def split(self) -> list[Group]:
        """The same checks, one per group."""
        return [replace(self, checks=(c,)) for c in self.checks]


def _counted(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One-row frame of counts, a column ``c<i>`` per check -> result rows."""
    none = F.lit(None).cast("double")
    rows = F.array(
        *[
            F.struct(
                F.lit(c.full_name).alias("check_name"),
                F.when(F.col(f"c{i}") == 0, Status.PASS.value)
                .otherwise(c.tier.failed_status.value)
                .alias("status"),
                *[none.alias(n) for n in RESULT_COLUMNS[2:6]],
                F.col(f"c{i}").alias("failure_count"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.inline(rows))


def _tag(checks: Sequence[Check], keys: Sequence[str], schema: T.StructType) -> Column:
    """Array of (check_name, order) of the predicates a row meets."""
    hits = [
        F.when(
            c.predicate,
            F.struct(F.lit(c.full_name).alias("check_name"), _order(_sample_columns(keys, c), schema).alias("_order")),
        )
        for c in checks
    ]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def _order(names: Sequence[str], schema: T.StructType) -> Column:
    """Text in the order of the JSON of the named columns."""
    parts = []
    for i, n in enumerate(names):
        text = F.coalesce(col(n).cast("string"), F.lit("null"))
        quoted = isinstance(schema[n].dataType, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))
        parts += [F.concat(F.lit('"'), text, F.lit('"')) if quoted else text, F.lit("," if i < len(names) - 1 else "}")]
    return F.concat(*parts)


def _first_keys(hits: DataFrame, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """(check_name, key_json, count) of (check_name, order, key, count): rows are cut on raw keys, and JSON is made of
    those that are left. ``columns`` names the fields of the key that a check shows."""
    kept = lowest(hits, "check_name", "_order", SAMPLE_SIZE)
    shown = lambda names: F.struct(*[F.col("_key").getField(n).alias(n) for n in names])
    json = [
        F.when(F.col("check_name") == check, F.to_json(shown(names), {"ignoreNullFields": "false"}))
        for check, names in columns.items()
    ]
    return kept.select("check_name", F.coalesce(*json).alias("key_json"), COUNT)


def _sample_columns(keys: Sequence[str], check: Check) -> list[str]:
    return [*keys, *[c for c in check.extra if c not in keys]]


@dataclass(frozen=True)
class RowGroup(Group):
    """Predicates over single rows of one frame, which is read when the group runs."""

    frame: Callable[[], DataFrame]
    keys: tuple[str, ...]

    def results(self) -> DataFrame:
        counts = self.frame().agg(
            *[F.count_if(c.predicate).alias(f"c{i}") for i, c in enumerate(self.checks)]
        )
        return _counted(counts, self.checks)

    def offenders(self, names: Sequence[str]) -> DataFrame:
        wanted = {c.full_name: _sample_columns(self.keys, c) for c in self.checks if c.full_name in names}
        frame = self.frame()
        every = list(dict.fromkeys(n for shown in wanted.values() for n in shown))
        tags = _tag([c for c in self.checks if c.full_name in wanted], self.keys, frame.schema)
        hits = frame.select(F.explode(tags).alias("_hit"), F.struct(*cols(every)).alias("_key"))
        return _first_keys(hits.select("_hit.*", "_key", F.lit(1).cast("bigint").alias(COUNT)), wanted)


@dataclass(frozen=True)
class KeyGroup(RowGroup):
    """Predicates over ``cnt``, the number of current versions of a key."""

    spec: object = None

    def _grouped(self) -> RowGroup:
        return RowGroup(self.checks, lambda: history.current_per_key(self.frame(), self.spec), self.keys)

    def results(self) -> DataFrame:
        return self._grouped().results()

    def offenders(self, names: Sequence[str]) -> DataFrame:
        return self._grouped().offenders(names)


@dataclass(frozen=True)
class FrameGroup(Group):
    """One check whose violations are a frame, which may have a count per row.

    ``listed`` gives the rows for the sample where they differ from the counted ones.
    """

    keys: tuple[str, ...]
    counted: Callable[[], DataFrame]
    listed: Callable[[], DataFrame] | None = None

    def results(self) -> DataFrame:
        rows = self.counted()
        each = F.col(COUNT) if COUNT in rows.columns else F.lit(1)
        total = F.coalesce(F.sum(each), F.lit(0)).cast("bigint").alias("c0")
        return _counted(rows.agg(total), self.checks)

    def offenders(self, names: Sequence[str]) -> DataFrame | None:
        check = self.checks[0]
        if check.full_name not in names:
            return None
        rows = (self.listed or self.counted)()
        count = F.col(COUNT) if COUNT in rows.columns else F.lit(1).cast("bigint")
        shown = _sample_columns(self.keys, check)
        hits = rows.select(
            F.lit(check.full_name).alias("check_name"),
            _order(shown, rows.schema).alias("_order"),
            F.struct(*cols(shown)).alias("_key"),
            count.alias(COUNT),
        )
        return _first_keys(hits, {check.full_name: shown})


@dataclass(frozen=True)
class ProfileGroup(Group):
    """The history checks that one pass over the ordered versions can count.

    ``measures`` names the count of each check; ``parts`` are the same checks one by one, for
    listing keys and for telling which check is at fault.
    """

    measures: tuple[str, ...]
    parts: tuple[Group, ...]
    build: Callable[[], DataFrame]

    def results(self) -> DataFrame:
        counts = self.build().select(*[F.col(m).alias(f"c{i}") for i, m in enumerate(self.measures)])
        return _counted(counts, self.checks)

    def offenders(self, names: Sequence[str]) -> DataFrame | None:
        return offenders(self.parts, names)

    def split(self) -> list[Group]:
        return [single for part in self.parts for single in part.split()]


@dataclass(frozen=True)
class ReconGroup(Group):
    """Two-sided comparisons; the frame builder takes the checks to compute."""

    build: Callable[[Sequence[Check]], DataFrame]

    def results(self) -> DataFrame:
        return self.build(self.checks)


# --- registry -> groups -------------------------------------------------------------------


def _csv(names: Sequence[str]) -> str:
    return ", ".join(names)


def completeness_groups(
    spec: TableSpec, tables: Tables, batch_id: str, strict_zero_base: bool = False
) -> list[Group]:
    h = spec.history

    def sides() -> tuple[DataFrame, DataFrame]:
        return tables.raw(spec.raw_table or spec.name), tables.curated(spec.name)

    batch = f"{spec.raw_batch} = :batch_id"

    def check(name, description, sql, extra=()):
        return Check(name, spec.name, COMPLETENESS, description, sql, None, extra)

    totals = [
        check(
            "row_count_bronze_vs_silver",
            "The batch has as many raw rows as rows it wrote to the curated table.",
            f"SELECT COUNT(*) FROM raw.{spec.raw_table or spec.name} WHERE {batch}; "
            f"SELECT COUNT(*) FROM curated.{spec.name} WHERE {h.batch} = :batch_id",
        )
    ]
    totals += [
        check(
            f"numeric_sum_{c}",
            f"The raw sum of {c} equals the sum over the batch's current curated rows.",
            f"SELECT COALESCE(SUM({c}), 0) FROM raw.{spec.raw_table or spec.name} WHERE {batch}; "
            f"SELECT COALESCE(SUM({c}), 0) FROM curated.{spec.name} "
            f"WHERE {h.batch} = :batch_id AND {h.is_current}",
            (c,),
        )
        for c in spec.sum_columns
    ]

    def build(checks: Sequence[Check]) -> DataFrame:
        columns = [c.extra[0] for c in checks if c.extra]
        rows = completeness.batch_recon(*sides(), h, batch_id, columns, spec.raw_batch, strict_zero_base)
        if all(c.extra for c in checks):
            rows = rows.where(F.col("metric").isNotNull())
        name = F.coalesce(F.concat(F.lit("numeric_sum_"), "metric"), F.lit("row_count_bronze_vs_silver"))
        return rows.select(
            F.concat(F.lit(f"{spec.name}."), name).alias("check_name"), *RESULT_COLUMNS[1:]
        )

    coverage = check(
        "key_coverage_bronze_to_silver",
        "Every raw business key of the batch has at least one curated version.",
        f"SELECT {_csv(h.keys)} FROM raw.{spec.raw_table or spec.name} b WHERE {batch} AND NOT EXISTS "
        f"(SELECT 1 FROM curated.{spec.name} s WHERE "
        + " AND ".join(f"s.{k} = b.{k}" for k in h.keys)
        + ")",
    )
    return [
        ReconGroup(tuple(totals), build),
        FrameGroup(
            (coverage,),
            h.keys,
            lambda: completeness.missing_keys(*sides(), h, batch_id, spec.raw_batch),
        ),
    ]


def history_groups(spec: TableSpec, tables: Tables) -> list[Group]:
    h, name = spec.history, spec.name

    def rows() -> DataFrame:
        return tables.curated(name)

    scan = f"SELECT {_csv(h.keys)} FROM curated.{name}"

    def check(short, description, sql, predicate=None):
        return Check(f"scd2_{short}", name, HISTORY, description, sql, predicate)

    per_key = (
        check(
            "no_duplicate_current",
            "A business key has at most one current version.",
            f"{scan} WHERE {h.is_current} GROUP BY {_csv(h.keys)} HAVING COUNT(*) > 1",
            F.col("cnt") > 1,
        ),
        check(
            "no_orphan_keys",
            "A business key has at least one current version.",
            f"{scan} GROUP BY {_csv(h.keys)} HAVING COUNT_IF({h.is_current}) = 0",
            F.col("cnt") == 0,
        ),
    )
    per_row = (
        check(
            "no_null_effective_start",
            "Every version has a start.",
            f"{scan} WHERE {h.start} IS NULL",
            history.is_null_start(h),
        ),
        check(
            "no_null_end_on_closed",
            "Every closed version has an end.",
            f"{scan} WHERE NOT {h.is_current} AND {h.end} IS NULL",
            history.is_open_closed(h),
        ),
        check(
            "start_lte_end",
            "No version starts after its end.",
            f"{scan} WHERE {h.end} IS NOT NULL AND {h.start} > {h.end}",
            history.is_inverted(h),
        ),
    )
    overlap = check(
        "no_overlapping_dates",
        "Versions of a business key do not overlap.",
        f"SELECT {_csv(['a.' + k for k in h.keys])} FROM curated.{name} a JOIN curated.{name} b ON "
        + " AND ".join(f"a.{k} = b.{k}" for k in h.keys)
        + f" AND a.{h.start} < b.{h.end} AND a.{h.end} > b.{h.start} AND a.{h.start} <> b.{h.start}",
    )
    chain = check(
        "chain_continuity",
        "A closed version ends where the next version of its key starts.",
        f"{scan} WHERE NOT {h.is_current} AND {h.end} <> LEAD({h.start}) OVER "
        f"(PARTITION BY {_csv(h.keys)} ORDER BY {h.start}, {h.end}, {h.is_current})",
    )
    parts = (
        KeyGroup(per_key, rows, h.keys, h),
        RowGroup(per_row, rows, h.keys),
        FrameGroup((chain,), h.keys, lambda: history.chain_continuity(rows(), h)),
    )
    return [
        ProfileGroup(
            (*per_key, *per_row, chain),
            history.PROFILE,
            parts,
            lambda: history.history_profile(rows(), h),
        ),
        FrameGroup((overlap,), h.keys, lambda: history.overlap_counts(rows(), h)),
    ]


def _parent_history(fk: ForeignKey, parents: Callable[[str], TableSpec]) -> HistorySpec:
    """How a referenced table marks current records; one that is not registered uses the default names."""
    try:
        return parents(fk.ref_table).history
    except ConfigError:
        return HistorySpec((fk.ref_column,))


def rule_groups(spec: TableSpec, tables: Tables, parents: Callable[[str], TableSpec]) -> list[Group]:
    h, name = spec.history, spec.name

    def rows() -> DataFrame:
        return tables.curated(name)

    scan = f"SELECT {_csv(h.keys)} FROM curated.{name}"

    def check(short, description, sql, predicate=None, extra=()):
        return Check(short, name, RULES, description, sql, predicate, extra)

    per_row = [
        check(
            f"required_field_{c}",
            f"Current records have a value in {c}.",
            f"{scan} WHERE {h.is_current} AND {c} IS NULL",
            rules.is_missing(h, c),
        )
        for c in spec.required
    ]
    for c, (low, high) in spec.ranges.items():
        outside = " OR ".join(
            ([f"{c} < {low}"] if low is not None else []) + ([f"{c} > {high}"] if high is not None else [])
        )
        per_row.append(
            check(
                f"range_{c}",
                f"Current records have {c} between {low} and {high}, None meaning no bound.",
                f"{scan} WHERE {h.is_current} AND ({outside})",
                rules.is_out_of_range(h, c, low, high),
                (c,),
            )
        )
    groups: list[Group] = []
    for rule, predicate in spec.rules.items():
        text = " ".join(predicate.split())
        made = check(f"rule_{rule}", f"No record breaks the rule: {rule.replace('_', ' ')}.", f"{scan} WHERE {text}")
        try:
            per_row.append(replace(made, predicate=F.expr(f"({predicate})")))
        except Exception:  # a predicate that does not parse fails when its own group is run
            groups.append(
                FrameGroup((made,), h.keys, lambda p=predicate: rules.conditional_rule(rows(), h, p))
            )
    if per_row:
        groups.insert(0, RowGroup(tuple(per_row), rows, h.keys))
    for fk in spec.foreign_keys:
        parent = _parent_history(fk, parents)
        made = check(
            f"fk_{fk.column}_to_{fk.ref_table}",
            f"{fk.column} of current records is {fk.ref_column} of a current {fk.ref_table} record.",
            f"{scan} s WHERE {h.is_current} AND {fk.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM "
            f"curated.{fk.ref_table} r WHERE r.{fk.ref_column} = s.{fk.column} "
            f"AND r.{parent.is_current})",
            None,
            (fk.column,),
        )
        groups.append(
            FrameGroup(
                (made,),
                h.keys,
                lambda fk=fk, p=parent: rules.dangling_values(rows(), tables.curated(fk.ref_table), h, fk, p),
                lambda fk=fk, p=parent: rules.foreign_key(rows(), tables.curated(fk.ref_table), h, fk, p),
            )
        )
    if spec.duplicate_rule:
        made = check(
            "duplicate_business_key",
            "A business key occurs once among current records.",
            f"{scan} WHERE {h.is_current} GROUP BY {_csv(h.keys)} HAVING COUNT(*) > 1",
            F.col("cnt") > 1,
        )
        groups.append(KeyGroup((made,), rows, h.keys, h))
    return groups


def recon_groups(
    spec: TableSpec,
    tables: Tables,
    source: Source,
    threshold_pct: float,
    strict_zero_base: bool = False,
) -> list[Group]:
    if not spec.metrics:
        return []
    checks = tuple(
        Check(
            f"source_recon_{m.name}",
            spec.name,
            RECON,
            f"{m.name} of current records is within {threshold_pct}% of the source.",
            f"SELECT {m.source_expr} FROM {spec.source_table}; "
            f"SELECT {m.curated_expr} FROM curated.{spec.name} WHERE {spec.history.is_current}",
            None,
            (m.name,),
        )
        for m in spec.metrics
    )

    def build(wanted: Sequence[Check]) -> DataFrame:
        names = {c.extra[0] for c in wanted}
        rows = recon.source_recon(
            source,
            spec.source_table,
            tables.curated(spec.name),
            spec.history,
            [m for m in spec.metrics if m.name in names],
            threshold_pct,
            strict_zero_base,
        )
        return rows.select(
            F.concat(F.lit(f"{spec.name}."), "check_name").alias("check_name"),
            *RESULT_COLUMNS[1:6],
            F.lit(None).cast("bigint").alias("failure_count"),
        )

    return [ReconGroup(checks, build)]


# --- groups -> frames ---------------------------------------------------------------------


def check_results(groups: Sequence[Group]) -> DataFrame:
    """Result rows of all groups in one frame, with table, tier and severity."""
    rows = reduce(DataFrame.unionByName, [_described(g) for g in groups])
    return rows


def _described(group: Group) -> DataFrame:
    first = group.checks[0]
    return group.results().select(
        *RESULT_COLUMNS,
        F.lit(first.table).alias("table_name"),
        F.lit(first.tier.number).cast("tinyint").alias("tier"),
        F.lit(first.tier.name).alias("tier_name"),
        F.lit(first.tier.category.value).alias("check_category"),
        F.lit(first.tier.severity.value).alias("severity"),
    )


def offenders(groups: Sequence[Group], names: Sequence[str] | None = None) -> DataFrame | None:
    """The first failing keys of each task, of the named checks or of all if none are named."""
    found = []
    for g in groups:
        mine = [c.full_name for c in g.checks if names is None or c.full_name in names]
        rows = g.offenders(mine) if mine else None
        if rows is not None:
            found.append(rows)
    return reduce(DataFrame.unionByName, found) if found else None

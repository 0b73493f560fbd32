"""SQL over the test tables that states what each registered query has to return.

The derived tables repeat ``tables.py`` as common table expressions. The checks are written the
direct way, with self-joins and NOT EXISTS, and share no structure with the Spark plans.
"""

from __future__ import annotations

CTES = {
    "bronze_customer": """
        SELECT c_custkey AS customer_id, c_name, c_mktsegment, 'B' || (c_custkey % 4) AS _batch_id
        FROM customer""",
    "silver_customer": """
        SELECT customer_id AS customer_id,
            CASE WHEN customer_id % 53 <> 0 THEN c_name || '@example.com' END AS email,
            CASE WHEN customer_id % 59 <> 0
                THEN CAST(DATE '1990-01-01' + CAST(customer_id % 3650 AS INT) AS DATE) END AS created_date,
            CASE WHEN c_mktsegment = 'MACHINERY' THEN 'CORPORATE' ELSE 'RETAIL' END AS account_type,
            CASE WHEN customer_id % 7 = 0 THEN '  ' WHEN customer_id % 11 = 0 THEN NULL ELSE c_name END
                AS company_name,
            v <> 'closed' AND customer_id % 137 <> 0 AS is_current,
            CAST(opened - CASE WHEN v = 'closed' THEN 200 ELSE 0 END AS DATE) AS effective_start_date,
            CASE WHEN v = 'current' THEN DATE '9999-12-31'
                WHEN customer_id % 61 = 0 THEN NULL
                WHEN customer_id % 67 = 0 THEN CAST(opened - 5 AS DATE)
                ELSE opened END AS effective_end_date,
            CASE WHEN v = 'closed' THEN 'B_hist' ELSE _batch_id END AS _batch_id
        FROM (SELECT *, CAST(DATE '2020-01-01' + CAST(customer_id % 365 AS INT) AS DATE) AS opened
              FROM bronze_customer) b, (VALUES ('closed'), ('current')) AS versions(v)
        WHERE v = 'current' OR customer_id % 4 = 0""",
    "bronze_order": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
            CASE o_orderstatus WHEN 'F' THEN 'SHIPPED' WHEN 'P' THEN 'CANCELLED' ELSE 'OPEN' END AS status,
            CAST(o_totalprice AS DECIMAL(18,2)) AS order_total,
            CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.08 AS DECIMAL(3,2)) AS tax_amount,
            CAST(o_orderdate AS DATE) AS order_date, 'B' || (o_orderkey % 4) AS _batch_id
        FROM orders""",
    "silver_order": """
        SELECT order_id AS order_id,
            CASE WHEN v = 'extra' THEN customer_id WHEN order_id % 139 = 0 THEN -customer_id - 1 WHEN order_id % 149 = 0 THEN NULL
                ELSE customer_id END AS customer_id,
            order_date, status,
            CASE WHEN v = 'extra' THEN order_total WHEN order_id % 151 = 0 THEN -order_total
                WHEN status = 'CANCELLED' AND order_id % 10 <> 0 THEN CAST(0 AS DECIMAL(18,2))
                ELSE order_total END AS order_total,
            tax_amount,
            CASE WHEN v = 'extra' OR (status = 'SHIPPED' AND order_id % 97 <> 0)
                THEN CAST(order_date + 3 AS DATE) END AS ship_date,
            CASE WHEN v = 'closed' THEN order_date
                WHEN v = 'extra' THEN CAST(order_date + 60 AS DATE)
                WHEN order_id % 113 = 0 THEN NULL
                WHEN order_id % 3 = 0 THEN CAST(order_date + 30 AS DATE)
                ELSE order_date END AS effective_start_date,
            CASE WHEN v <> 'closed' THEN DATE '9999-12-31'
                WHEN order_id % 127 = 0 THEN NULL
                WHEN order_id % 107 = 0 THEN CAST(order_date + 40 AS DATE)
                WHEN order_id % 109 = 0 THEN CAST(order_date + 20 AS DATE)
                WHEN order_id % 131 = 0 THEN CAST(order_date - 1 AS DATE)
                ELSE CAST(order_date + 30 AS DATE) END AS effective_end_date,
            CASE v WHEN 'closed' THEN false WHEN 'extra' THEN true ELSE order_id % 137 <> 0 END AS is_current,
            CASE WHEN v = 'closed' THEN 'B_hist' ELSE _batch_id END AS _batch_id
        FROM bronze_order, (VALUES ('closed'), ('current'), ('extra')) AS versions(v)
        WHERE order_id % 101 <> 0
          AND (v = 'current' OR (v = 'closed' AND order_id % 3 = 0) OR (v = 'extra' AND order_id % 103 = 0))""",
    "bronze_order_line": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_number, min(l_partkey) AS product_id,
            max(l_quantity) AS quantity, CAST(max(l_extendedprice) AS DECIMAL(18,2)) AS line_total,
            min(CAST(l_shipdate AS DATE)) AS ship_date, 'B' || (l_orderkey % 4) AS _batch_id
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "silver_order_line": """
        SELECT order_id AS order_id, line_number, product_id,
            CASE WHEN order_id % 157 = 0 THEN 0.0 WHEN order_id % 163 = 0 THEN 10001.0 ELSE quantity END
                AS quantity,
            CASE WHEN order_id % 167 = 0 THEN NULL
                WHEN order_id % 173 = 0 THEN -(line_total * CAST(0.10 AS DECIMAL(3,2)))
                ELSE line_total * CAST(0.10 AS DECIMAL(3,2)) END AS unit_price,
            line_total, v <> 'closed' AS is_current,
            CAST(ship_date - CASE WHEN v = 'closed' THEN 30 ELSE 0 END AS DATE) AS effective_start_date,
            CASE WHEN v = 'current' THEN DATE '9999-12-31'
                WHEN order_id % 179 = 0 THEN CAST(ship_date + 10 AS DATE)
                WHEN order_id % 181 = 0 THEN CAST(ship_date - 5 AS DATE)
                ELSE ship_date END AS effective_end_date,
            CASE WHEN v = 'closed' THEN 'B_hist' ELSE _batch_id END AS _batch_id
        FROM bronze_order_line, (VALUES ('closed'), ('current')) AS versions(v)
        WHERE NOT (order_id % 89 = 0 AND line_number = 1)
          AND (v = 'current' OR (order_id + line_number) % 5 = 0)""",
    "source_order": """
        SELECT order_id AS OrderID, order_total AS OrderTotal, tax_amount AS TaxAmount FROM bronze_order""",
    "check_log": """
        SELECT 'c' || event_id AS check_id,
            strftime(ts, '%Y-%m-%d-%H') || '-' || (user_id % 4 + 1) AS run_id,
            strftime(ts, '%Y-%m-%d-%H') AS pipeline_run_id, 'B' || (event_id % 4) AS batch_id,
            ts AS checked_at, user_id % 4 + 1 AS tier,
            CASE user_id % 4 WHEN 0 THEN 'Completeness' WHEN 1 THEN 'SCD2 Integrity'
                WHEN 2 THEN 'Business Rules' ELSE 'Source Reconciliation' END AS tier_name,
            'order' AS table_name, 'order.' || event_type AS check_name,
            CASE user_id % 4 WHEN 0 THEN 'COMPLETENESS' WHEN 1 THEN 'SCD2'
                WHEN 2 THEN 'BUSINESS_RULE' ELSE 'SOURCE_RECON' END AS check_category,
            'check of ' || event_type AS check_description,
            CASE WHEN event_id % 10 = 0 THEN 'FAIL' WHEN event_id % 10 IN (1, 2) THEN 'WARN' ELSE 'PASS' END
                AS status,
            CASE WHEN user_id % 4 < 2 THEN 'BLOCKING' ELSE 'WARNING' END AS severity,
            CAST(100 AS DOUBLE) AS expected_value, CAST(event_id % 13 + 100 AS DOUBLE) AS actual_value,
            CAST(event_id % 13 AS DOUBLE) AS variance_value,
            CAST(event_id % 1000 AS DOUBLE) / CAST(7 AS DOUBLE) AS variance_pct,
            CASE WHEN event_id % 10 <= 2 THEN event_id % 7 + 1 ELSE 0 END AS failure_count,
            CASE WHEN event_id % 10 <= 2 THEN '[{"event_id":' || event_id || '}]' END AS failure_sample,
            'SELECT ' || event_type AS sql_query, event_id % 997 AS execution_ms,
            CAST(ts AS DATE) AS check_date
        FROM events""",
    "run_log": """
        SELECT run_id, pipeline_run_id, min(batch_id) AS batch_id, 'ALL' AS table_name, tier, tier_name,
            min(checked_at) AS started_at, max(checked_at) AS completed_at,
            CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN'
                ELSE 'PASS' END AS status,
            count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed_checks,
            count(*) FILTER (WHERE status = 'FAIL') AS failed_checks,
            count(*) FILTER (WHERE status = 'WARN') AS warned_checks
        FROM check_log GROUP BY run_id, pipeline_run_id, tier, tier_name""",
    "snapshot_sums": """
        SELECT CAST(ts AS DATE) AS snapshot_date, event_type,
            CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))), 0) AS DOUBLE) AS source_value,
            CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_id % 50 <> 0), 0) AS DOUBLE)
                AS silver_value
        FROM events GROUP BY ALL""",
    "snapshots": """
        SELECT *, CASE WHEN source_value = 0 THEN 0.0
            ELSE (silver_value - source_value) / source_value * 100 END AS variance_pct
        FROM snapshot_sums""",
}
_NEEDS = {
    "silver_customer": ("bronze_customer",),
    "silver_order": ("bronze_order",),
    "silver_order_line": ("bronze_order_line",),
    "source_order": ("bronze_order",),
    "run_log": ("check_log",),
    "snapshots": ("snapshot_sums",),
}


def _with(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    wanted: list[str] = []
    for n in names:
        for m in (*_NEEDS.get(n, ()), n):
            if m not in wanted:
                wanted.append(m)
    parts = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in wanted]
    parts += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}"


KEYS = {"customer": ["customer_id"], "order": ["order_id"], "order_line": ["order_id", "line_number"]}


def _csv(table: str, alias: str = "") -> str:
    return ", ".join(f"{alias}{k}" for k in KEYS[table])


def _on(table: str, a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in KEYS[table])


def _json(columns: list[str]) -> str:
    inner = " || ',' || ".join(
        f"""'"{c}":' || coalesce(CAST({c} AS VARCHAR), 'null')""" for c in columns
    )
    return "'{' || " + inner + " || '}'"


# Violations of each check as a SELECT over the derived tables.


def v_coverage(t: str) -> str:
    return (
        f"SELECT {_csv(t, 'b.')} FROM bronze_{t} b WHERE b._batch_id = 'B1' AND NOT EXISTS "
        f"(SELECT 1 FROM silver_{t} s WHERE {_on(t, 's', 'b')})"
    )


def v_duplicate(t: str) -> str:
    return f"SELECT {_csv(t)}, count(*) AS cnt FROM silver_{t} WHERE is_current GROUP BY {_csv(t)} HAVING count(*) > 1"


def v_overlap(t: str) -> str:
    """Pairs of versions, put together from one list per key with several of them."""
    known = " AND ".join(f"{k.strip()} IS NOT NULL" for k in _csv(t).split(","))
    return f"""SELECT {_csv(t)}, a.s AS a_start, a.e AS a_end, b.s AS b_start, b.e AS b_end FROM (
        SELECT *, unnest(v) AS b FROM (
            SELECT *, unnest(v) AS a FROM (
                SELECT {_csv(t)}, list(struct_pack(s := effective_start_date, e := effective_end_date)) AS v
                FROM silver_{t} WHERE {known} GROUP BY {_csv(t)} HAVING count(*) > 1)))
        WHERE a.s < b.e AND a.e > b.s AND a.s <> b.s"""


def v_chain(t: str) -> str:
    return f"""SELECT {_csv(t)}, effective_start_date, effective_end_date, next_start FROM (
        SELECT *, lead(effective_start_date) OVER (PARTITION BY {_csv(t)} ORDER BY
            effective_start_date NULLS FIRST, effective_end_date NULLS FIRST, is_current NULLS FIRST) AS next_start
        FROM silver_{t}) WHERE NOT is_current AND next_start IS NOT NULL AND effective_end_date <> next_start"""


def v_where(t: str, predicate: str, more: str = "") -> str:
    return f"SELECT {_csv(t)}{more} FROM silver_{t} WHERE {predicate}"


def v_orphan(t: str) -> str:
    return (
        f"SELECT {_csv(t)} FROM silver_{t} GROUP BY {_csv(t)} "
        "HAVING sum(CASE WHEN is_current THEN 1 ELSE 0 END) = 0"
    )


def v_fk(t: str, fk: str, parent: str, ref: str) -> str:
    more = "" if fk in KEYS[t] else f", s.{fk}"
    return (
        f"SELECT {_csv(t, 's.')}{more} FROM silver_{t} s WHERE s.is_current AND s.{fk} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM silver_{parent} r WHERE r.{ref} = s.{fk} AND r.is_current)"
    )


# The parent is no registered table: a part is current unless its number ends in 0.
PRODUCT_FK = """SELECT order_id, line_number, product_id FROM silver_order_line s
    WHERE s.is_current AND s.product_id IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM lineitem r WHERE r.l_partkey = s.product_id AND r.l_partkey % 10 <> 0)"""
NULL_START = "effective_start_date IS NULL"
NULL_END = "NOT is_current AND effective_end_date IS NULL"
INVERTED = "effective_end_date IS NOT NULL AND effective_start_date > effective_end_date"
SHIPPED = "is_current = true AND status = 'SHIPPED' AND ship_date IS NULL"
CANCELLED = "is_current = true AND status = 'CANCELLED' AND order_total > 0"
CORPORATE = "is_current = true AND account_type = 'CORPORATE' AND (company_name IS NULL OR trim(company_name) = '')"


def _history(t: str) -> dict[str, str]:
    return {
        f"{t}.scd2_no_duplicate_current": v_duplicate(t),
        f"{t}.scd2_no_overlapping_dates": v_overlap(t),
        f"{t}.scd2_chain_continuity": v_chain(t),
        f"{t}.scd2_no_null_effective_start": v_where(t, NULL_START),
        f"{t}.scd2_no_null_end_on_closed": v_where(t, NULL_END),
        f"{t}.scd2_start_lte_end": v_where(t, INVERTED),
        f"{t}.scd2_no_orphan_keys": v_orphan(t),
    }


# Stated apart from the registry on purpose: the SQL must not follow a mistake made there.
REQUIRED = {
    "customer": ["customer_id", "email", "created_date"],
    "order": ["order_id", "customer_id", "order_date", "status"],
    "order_line": ["order_id", "line_number", "product_id", "quantity", "unit_price"],
}
RANGES = {
    "customer": {},
    "order": {"order_total": "order_total < 0", "tax_amount": "tax_amount < 0"},
    "order_line": {
        "quantity": "(quantity < 1 OR quantity > 10000)",
        "unit_price": "unit_price < 0",
        "line_total": "line_total < 0",
    },
}
RULES = {
    "customer": {"corporate_account_must_have_company_name": CORPORATE},
    "order": {
        "shipped_order_must_have_ship_date": SHIPPED,
        "cancelled_order_total_must_be_zero_or_negative": CANCELLED,
    },
    "order_line": {},
}
FKS = {
    "customer": [],
    "order": [("customer_id", "customer", "customer_id")],
    "order_line": [("order_id", "order", "order_id")],
}


def _rules(t: str) -> dict[str, tuple[str, list[str]]]:
    """Check -> (violations, columns of its sample)."""
    keys = KEYS[t]
    out = {f"{t}.required_field_{c}": (v_where(t, f"is_current AND {c} IS NULL"), keys) for c in REQUIRED[t]}
    for c, p in RANGES[t].items():
        out[f"{t}.range_{c}"] = (v_where(t, f"is_current AND {p}", f", {c}"), [*keys, c])
    for fk, parent, ref in FKS[t]:
        columns = keys if fk in keys else [*keys, fk]
        out[f"{t}.fk_{fk}_to_{parent}"] = (v_fk(t, fk, parent, ref), columns)
    for name, p in RULES[t].items():
        out[f"{t}.rule_{name}"] = (v_where(t, p), keys)
    return out


SILVER = ["silver_customer", "silver_order", "silver_order_line"]


def _counted(checks: dict[str, str], bad: str, severity: str, tier: int) -> str:
    return " UNION ALL ".join(
        f"SELECT {tier} AS tier, '{name}' AS check_name, CASE WHEN count(*) = 0 THEN 'PASS' ELSE '{bad}' END AS status, "
        f"'{severity}' AS severity, count(*) AS failure_count, CAST(NULL AS DOUBLE) AS expected_value, "
        f"CAST(NULL AS DOUBLE) AS actual_value, CAST(NULL AS DOUBLE) AS variance_pct FROM ({sql})"
        for name, sql in checks.items()
    )


def _compared(name: str, expected: str, actual: str) -> str:
    return f"SELECT '{name}' AS check_name, ({expected}) AS e, ({actual}) AS a"


_PCT = "CASE WHEN e = 0 THEN 0.0 ELSE (a - e) / e * 100 END"


def _batch_sum(t: str, c: str) -> tuple[str, str]:
    return (
        f"SELECT CAST(coalesce(sum({c}), 0) AS DOUBLE) FROM bronze_{t} WHERE _batch_id = 'B1'",
        f"SELECT CAST(coalesce(sum({c}), 0) AS DOUBLE) FROM silver_{t} WHERE _batch_id = 'B1' AND is_current",
    )


def _batch_rows(t: str) -> tuple[str, str]:
    return tuple(
        f"SELECT CAST(count(*) AS DOUBLE) FROM {layer}_{t} WHERE _batch_id = 'B1'" for layer in ("bronze", "silver")
    )


SUMS = {"customer": [], "order": ["order_total", "tax_amount"], "order_line": ["line_total", "quantity"]}


def _tier1() -> str:
    parts = []
    for t in KEYS:
        rows = _compared(f"{t}.row_count_bronze_vs_silver", *_batch_rows(t))
        parts.append(
            "SELECT 1 AS tier, check_name, CASE WHEN a = e THEN 'PASS' ELSE 'FAIL' END AS status, 'BLOCKING' AS severity, "
            f"CAST(abs(a - e) AS BIGINT) AS failure_count, e AS expected_value, a AS actual_value, {_PCT} AS variance_pct "
            f"FROM ({rows})"
        )
        for c in SUMS[t]:
            sums = _compared(f"{t}.numeric_sum_{c}", *_batch_sum(t, c))
            parts.append(
                f"SELECT 1 AS tier, check_name, CASE WHEN abs({_PCT}) < 0.001 THEN 'PASS' ELSE 'FAIL' END AS status, "
                "'BLOCKING' AS severity, CAST(NULL AS BIGINT) AS failure_count, e AS expected_value, a AS actual_value, "
                f"{_PCT} AS variance_pct FROM ({sums})"
            )
    covered = {f"{t}.key_coverage_bronze_to_silver": v_coverage(t) for t in KEYS}
    return " UNION ALL ".join([*parts, _counted(covered, "FAIL", "BLOCKING", 1)])


def _tier2() -> str:
    return _counted({k: v for t in KEYS for k, v in _history(t).items()}, "FAIL", "BLOCKING", 2)


def _tier3() -> str:
    return _counted({k: v[0] for t in KEYS for k, v in _rules(t).items()}, "WARN", "WARNING", 3)


METRICS = {
    "customer": [("row_count", "bronze_customer", "count(*)", "count(*)")],
    "order": [
        ("row_count", "source_order", "count(*)", "count(*)"),
        ("sum_order_total", "source_order", "sum(OrderTotal)", "sum(order_total)"),
        ("sum_tax_amount", "source_order", "sum(TaxAmount)", "sum(tax_amount)"),
    ],
}


def _metric(t: str, name: str, src: str, a: str, b: str) -> str:
    return _compared(
        name,
        f"SELECT CAST(coalesce({a}, 0) AS DOUBLE) FROM {src}",
        f"SELECT CAST(coalesce({b}, 0) AS DOUBLE) FROM silver_{t} WHERE is_current",
    )


def _tier4() -> str:
    rows = " UNION ALL ".join(
        _metric(t, f"{t}.source_recon_{n}", src, a, b) for t, ms in METRICS.items() for n, src, a, b in ms
    )
    return (
        f"SELECT 4 AS tier, check_name, CASE WHEN abs({_PCT}) <= 1.0 THEN 'PASS' ELSE 'WARN' END AS status, "
        "'WARNING' AS severity, CAST(NULL AS BIGINT) AS failure_count, e AS expected_value, a AS actual_value, "
        f"{_PCT} AS variance_pct FROM ({rows})"
    )


_RECON = "e AS expected_value, a AS actual_value, a - e AS variance_value, " + _PCT + " AS variance_pct"


def _sum_recon(t: str) -> str:
    rows = " UNION ALL ".join(_compared(f"numeric_sum_{c}", *_batch_sum(t, c)) for c in SUMS[t])
    return _with(
        [f"silver_{t}"],
        f"SELECT check_name, {_RECON}, CASE WHEN abs({_PCT}) < 0.001 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({rows})",
    )


def _source_recon(rows: str, threshold: float) -> str:
    return (
        f"SELECT check_name, {_RECON}, CASE WHEN abs({_PCT}) <= {threshold} THEN 'PASS' ELSE 'WARN' END AS status, "
        f"abs({_PCT}) <= {threshold} AS within_threshold FROM ({rows})"
    )


def _sampled() -> str:
    checks = {k: (v, KEYS["order"]) for k, v in _history("order").items()} | _rules("order")
    parts = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, {_json(columns)} AS j FROM ({sql})" for name, (sql, columns) in checks.items()
    )
    return (
        "SELECT check_name, '[' || string_agg(j, ',' ORDER BY j) || ']' AS failure_sample FROM ("
        f"SELECT check_name, j, row_number() OVER (PARTITION BY check_name ORDER BY j) AS r FROM ({parts})) "
        "WHERE r <= 10 GROUP BY check_name"
    )


_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"
_GATE = """
    coalesce(bool_and(status = 'PASS') FILTER (WHERE tier = 1), false) AS tier1_pass,
    coalesce(bool_and(status = 'PASS') FILTER (WHERE tier = 2), false) AS tier2_pass,
    coalesce(bool_and(status = 'PASS') FILTER (WHERE tier = 3), false) AS tier3_pass,
    coalesce(bool_and(status = 'PASS') FILTER (WHERE tier = 4), true) AS tier4_pass,
    coalesce(bool_and(status = 'PASS') FILTER (WHERE tier = 1), false)
        AND coalesce(bool_and(status = 'PASS') FILTER (WHERE tier = 2), false) AS overall_pass"""
_SUMMARY = """SELECT tier, CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN'
    ELSE 'PASS' END AS status, count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed_checks,
    count(*) FILTER (WHERE status = 'FAIL') AS failed_checks, count(*) FILTER (WHERE status = 'WARN') AS warned_checks
    FROM all_checks GROUP BY tier"""


def _required(t: str) -> str:
    return _with(
        [f"silver_{t}"],
        " UNION ALL ".join(
            f"SELECT {_csv(t)}, '{c}' AS column_name FROM silver_{t} WHERE is_current AND {c} IS NULL"
            for c in REQUIRED[t]
        ),
    )


def oracle_sql() -> dict[str, str]:
    layers = [*SILVER, "source_order"]
    everything = {"all_checks": " UNION ALL ".join([_tier1(), _tier2(), _tier3(), _tier4()])}
    order, line = ["silver_order"], ["silver_order_line"]
    result = "check_name, status, severity, failure_count"
    line_key = "order_id, CAST(line_number AS BIGINT) AS line_number"
    span_pairs = """WITH spans AS MATERIALIZED (SELECT event_type, {s} AS s, {e} AS e FROM events)
        SELECT a.event_type, count(*) AS pairs FROM spans a JOIN spans b ON a.event_type = b.event_type
        AND a.s < b.e AND a.e > b.s AND a.s <> b.s GROUP BY a.event_type"""
    sql = {
        "scan_batch_slice": _with(["bronze_order"], "SELECT * FROM bronze_order WHERE _batch_id = 'B1'"),
        "scan_current": _with(
            order,
            "SELECT order_id, customer_id, order_total, effective_start_date, effective_end_date "
            "FROM silver_order WHERE is_current",
        ),
        "row_count_recon": _with(
            order,
            f"SELECT check_name, {_RECON}, CASE WHEN a = e THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"CAST(abs(a - e) AS BIGINT) AS failure_count FROM ({_compared('row_count', *_batch_rows('order'))})",
        ),
        "key_coverage": _with(order, v_coverage("order")),
        "key_coverage_order_line": _with(line, v_coverage("order_line")),
        "numeric_sum_recon": _sum_recon("order"),
        "numeric_sum_recon_order_line": _sum_recon("order_line"),
        "dup_current": _with(order, v_duplicate("order")),
        "dup_current_lineitem": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS cnt "
        "FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
        "overlap_pairs": _with(order, v_overlap("order")),
        "overlap_pairs_order_line": _with(
            line,
            f"SELECT {line_key}, a_start, a_end, b_start, b_end FROM ({v_overlap('order_line')})",
        ),
        "overlap_counts_event_spans": span_pairs.format(
            s="CAST(ts AS DATE)", e="CAST(CAST(ts AS DATE) + CAST(event_id % 4 - 1 AS INT) AS DATE)"
        ),
        "overlap_counts_event_times": span_pairs.format(s="ts", e="ts + to_hours(CAST(event_id % 7 - 2 AS INT))"),
        "chain_continuity": _with(order, v_chain("order")),
        "chain_continuity_customer": _with(["silver_customer"], v_chain("customer")),
        "null_start": _with(order, v_where("order", NULL_START)),
        "null_end_closed": _with(order, v_where("order", NULL_END)),
        "start_lte_end": _with(order, v_where("order", INVERTED, ", effective_start_date, effective_end_date")),
        "orphan_keys": _with(order, v_orphan("order")),
        "required_fields": _required("order"),
        "required_fields_customer": _required("customer"),
        "numeric_range": _with(order, v_where("order", "is_current AND order_total < 0", ", order_total")),
        "numeric_ranges_order_line": _with(
            line,
            " UNION ALL ".join(
                f"SELECT {line_key}, '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM silver_order_line "
                f"WHERE is_current AND {p}"
                for c, p in RANGES["order_line"].items()
            ),
        ),
        "foreign_key": _with(["silver_customer", *order], v_fk("order", "customer_id", "customer", "customer_id")),
        "foreign_key_order_line": _with(
            [*order, *line],
            f"SELECT {line_key} FROM ({v_fk('order_line', 'order_id', 'order', 'order_id')})",
        ),
        "foreign_key_product": _with(line, f"SELECT {line_key}, product_id FROM ({PRODUCT_FK})"),
        "rule_shipped_has_date": _with(order, v_where("order", SHIPPED)),
        "rule_cancelled_total": _with(order, v_where("order", CANCELLED)),
        "rule_corporate_name": _with(["silver_customer"], v_where("customer", CORPORATE)),
        "dup_business_key": _with(order, v_duplicate("order")),
        "source_recon": _with(
            [*order, "source_order"],
            _source_recon(
                " UNION ALL ".join(
                    _metric("order", f"source_recon_{n}", src, a, b) for n, src, a, b in METRICS["order"]
                ),
                1.0,
            ),
        ),
        "source_recon_distinct": _with(
            [*order, "source_order"],
            _source_recon(
                _metric(
                    "order",
                    "source_recon_entities",
                    "source_order",
                    "count(DISTINCT OrderID)",
                    "count(DISTINCT order_id)",
                )
                + " UNION ALL "
                + _metric(
                    "order",
                    "source_recon_large_orders",
                    "source_order",
                    "count(*) FILTER (WHERE OrderTotal > 300000)",
                    "count(*) FILTER (WHERE order_total > 300000)",
                ),
                5.0,
            ),
        ),
        "recon_snapshot": _with(
            [*order, "source_order"],
            "SELECT 'run-1' AS run_id, DATE '2024-01-31' AS snapshot_date, 'order' AS table_name, "
            f"check_name AS metric_name, e AS source_value, a AS silver_value, a - e AS variance_value, {_PCT} AS variance_pct, "
            f"abs({_PCT}) <= 1.0 AS within_threshold, CAST(1.0 AS DOUBLE) AS threshold_pct FROM ("
            + " UNION ALL ".join(_metric("order", n, src, a, b) for n, src, a, b in METRICS["order"])
            + ")",
        ),
        "check_results_completeness": _with(
            SILVER, f"SELECT {result}, expected_value, actual_value, variance_pct FROM ({_tier1()})"
        ),
        "check_results_history": _with(SILVER, f"SELECT {result} FROM ({_tier2()})"),
        "check_results_rules": _with(SILVER, f"SELECT {result} FROM ({_tier3()})"),
        "check_results_more_rules": _with(
            SILVER,
            f"""SELECT {result} FROM ({_counted({
                "order.duplicate_business_key": v_duplicate("order"),
                "order_line.fk_product_id_to_product": PRODUCT_FK,
            }, "WARN", "WARNING", 3)})""",
        ),
        "check_results_recon": _with(
            layers,
            f"SELECT check_name, status, severity, expected_value, actual_value, variance_pct FROM ({_tier4()})",
        ),
        "failure_sample": _with(["silver_customer", *order], _sampled()),
        "run_summary": _with(layers, f"SELECT CAST(tier AS BIGINT) AS tier, * EXCLUDE (tier) FROM ({_SUMMARY})", everything),
        "pipeline_gate": _with(layers, f"SELECT {_GATE} FROM ({_SUMMARY})", everything),
        "pipeline_gate_by_run": _with(
            ["run_log"],
            f"""SELECT pipeline_run_id, {_GATE} FROM (
                SELECT *, row_number() OVER (PARTITION BY pipeline_run_id, tier
                    ORDER BY started_at DESC, completed_at DESC NULLS LAST, run_id DESC) AS place
                FROM (SELECT run_id, pipeline_run_id, tier, started_at, completed_at, status FROM run_log
                    UNION ALL SELECT run_id || '-again', pipeline_run_id, tier, started_at + INTERVAL 1 DAY,
                        started_at + INTERVAL 1 DAY, 'PASS' FROM run_log WHERE status <> 'PASS' AND tier = 1
                    UNION ALL SELECT run_id || '-open', pipeline_run_id, tier, started_at + INTERVAL 1 DAY, NULL,
                        'RUNNING' FROM run_log WHERE warned_checks = 0 AND tier = 2)
            ) WHERE place = 1 GROUP BY pipeline_run_id""",
        ),
        "check_log_roundtrip": _with(
            ["check_log"], f"SELECT * EXCLUDE (checked_at), {_TS.format('checked_at')} FROM check_log"
        ),
        "check_log_published": _with(
            ["run_log"],
            f"""SELECT check_id, run_id, {_TS.format('checked_at')}, check_name, status FROM check_log
            WHERE run_id IN (SELECT run_id FROM run_log WHERE status <> 'PASS')""",
        ),
        "run_upsert": _with(
            ["run_log"],
            f"""SELECT run_id, pipeline_run_id, batch_id, table_name, tier, tier_name, {_TS.format('started_at')},
            CASE WHEN status <> 'PASS' THEN strftime(completed_at, '%Y-%m-%d %H:%M:%S.%f') END AS completed_at,
            CASE WHEN status <> 'PASS' THEN status ELSE 'RUNNING' END AS status,
            """
            + ", ".join(
                f"CASE WHEN status <> 'PASS' THEN {c} END AS {c}"
                for c in ("total_checks", "passed_checks", "failed_checks", "warned_checks")
            )
            + ", 'workload' AS run_by, 'test' AS env FROM run_log",
        ),
        "run_latest": _with(
            ["run_log"], f"SELECT run_id, status, {_TS.format('completed_at')}, total_checks FROM run_log"
        ),
        "recent_runs": _with(
            ["run_log"],
            """SELECT CAST(started_at AS DATE) AS run_date, tier_name, status, total_checks, passed_checks, failed_checks,
            warned_checks, pipeline_run_id, batch_id, date_sub('second', started_at, completed_at) AS duration_sec
            FROM run_log WHERE started_at >= DATE '2024-01-24'""",
        ),
        "open_issues": _with(
            ["check_log"],
            f"""SELECT {_TS.format('checked_at')}, tier_name, table_name, check_name, status, severity, check_description,
            failure_count, expected_value, actual_value, round(variance_pct, 2) AS variance_pct, failure_sample,
            execution_ms FROM check_log WHERE status IN ('FAIL', 'WARN') AND checked_at >= DATE '2024-01-24'""",
        ),
        "pass_rate_trend": _with(
            ["check_log"],
            """SELECT check_date, tier_name, count(*) AS total, count(*) FILTER (WHERE status = 'PASS') AS passed,
            count(*) FILTER (WHERE status = 'FAIL') AS failed, count(*) FILTER (WHERE status = 'WARN') AS warned,
            round(CAST(count(*) FILTER (WHERE status = 'PASS') * 100 AS DOUBLE) / count(*), 1) AS pass_rate_pct
            FROM check_log WHERE checked_at >= DATE '2024-01-01' GROUP BY check_date, tier_name""",
        ),
        "recon_drift": _with(
            ["snapshots"],
            """SELECT snapshot_date, 'order' AS table_name, 'sum_' || event_type AS metric_name, source_value, silver_value,
            round(variance_pct, 4) AS variance_pct, abs(variance_pct) <= 1.0 AS within_threshold,
            CAST(1.0 AS DOUBLE) AS threshold_pct FROM snapshots""",
        ),
        "slowest_checks": _with(
            ["check_log"],
            """SELECT check_name, table_name, tier_name, round(avg(execution_ms), 0) AS avg_ms,
            max(execution_ms) AS max_ms, count(*) AS run_count FROM check_log WHERE checked_at >= DATE '2024-01-01'
            GROUP BY ALL ORDER BY avg_ms DESC, check_name, table_name, tier_name LIMIT 20""",
        ),
        "check_drilldown": _with(
            ["check_log"],
            f"""SELECT {_TS.format('checked_at')}, batch_id, status, failure_count, failure_sample, sql_query FROM (
            SELECT * FROM check_log WHERE check_name = 'order.purchase' AND checked_at >= DATE '2024-01-15'
            ORDER BY check_log.checked_at DESC LIMIT 10)""",
        ),
    }
    # Reports from totals of days are the reports themselves.
    return sql | {f"{name}_of_days": sql[name] for name in ("pass_rate_trend", "slowest_checks")}

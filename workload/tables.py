"""Raw, curated and log tables derived from the test data, with known defects.

A defect is planted where the key is divisible by a number; see FIXTURES.md. ``clean=True``
leaves the defects out. ``oracle.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.config import RECON, TIERS, ForeignKey, HistorySpec, Metric, Registry, TableSpec
from tablegate.plans.results import run_summary
from tablegate.sources.tables import FrameSource, FrameTables

BATCH = "B1"
OPEN_END = "9999-12-31"

CUSTOMER = HistorySpec(("customer_id",))
ORDER = HistorySpec(("order_id",))
ORDER_LINE = HistorySpec(("order_id", "line_number"))

# The rule predicates below, and all names, columns, bounds and expressions of the registry.
SHIPPED_HAS_DATE = "is_current = true AND status = 'SHIPPED' AND ship_date IS NULL"
CANCELLED_TOTAL = "is_current = true AND status = 'CANCELLED' AND order_total > 0"
CORPORATE_NAME = (
    "is_current = true AND account_type = 'CORPORATE' AND (company_name IS NULL OR TRIM(company_name) = '')"
)

REGISTRY = Registry(
    [
        TableSpec(
            "customer",
            CUSTOMER,
            required=("customer_id", "email", "created_date"),
            rules={"corporate_account_must_have_company_name": CORPORATE_NAME},
            source_table="dbo.Customer",
            metrics=(Metric("row_count", "COUNT(*)", "COUNT(*)"),),
        ),
        TableSpec(
            "order",
            ORDER,
            sum_columns=("order_total", "tax_amount"),
            required=("order_id", "customer_id", "order_date", "status"),
            ranges={"order_total": (0, None), "tax_amount": (0, None)},
            foreign_keys=(ForeignKey("customer_id", "customer", "customer_id"),),
            rules={
                "shipped_order_must_have_ship_date": SHIPPED_HAS_DATE,
                "cancelled_order_total_must_be_zero_or_negative": CANCELLED_TOTAL,
            },
            source_table="dbo.SalesOrder",
            metrics=(
                Metric("row_count", "COUNT(*)", "COUNT(*)"),
                Metric("sum_order_total", "SUM(OrderTotal)", "SUM(order_total)"),
                Metric("sum_tax_amount", "SUM(TaxAmount)", "SUM(tax_amount)"),
            ),
        ),
        TableSpec(
            "order_line",
            ORDER_LINE,
            sum_columns=("line_total", "quantity"),
            required=("order_id", "line_number", "product_id", "quantity", "unit_price"),
            ranges={"quantity": (1, 10000), "unit_price": (0, None), "line_total": (0, None)},
            foreign_keys=(ForeignKey("order_id", "order", "order_id"),),
        ),
    ]
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hit(key: Column, modulus: int, clean: bool) -> Column:
    return F.lit(False) if clean else (key % modulus) == 0


def _versions(**present: Column) -> Column:
    """One row per version whose condition holds."""
    made = F.array(*[F.when(c, F.lit(n)) for n, c in present.items()])
    return F.explode(F.filter(made, lambda x: x.isNotNull()))


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


def bronze_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        "c_name",
        "c_mktsegment",
        F.concat(F.lit("B"), (F.col("c_custkey") % 4).cast("string")).alias("_batch_id"),
    )


def silver_customer(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    raw, k = bronze_customer(spark, sf_dir), F.col("customer_id")
    rows = raw.withColumn("version", _versions(closed=k % 4 == 0, current=F.lit(True)))
    closed = F.col("version") == "closed"
    opened = F.date_add(_date("2020-01-01"), (k % 365).cast("int"))
    machinery = F.col("c_mktsegment") == "MACHINERY"
    return rows.select(
        k,
        F.when(~_hit(k, 53, clean), F.concat("c_name", F.lit("@example.com"))).alias("email"),
        F.when(
            ~_hit(k, 59, clean), F.date_add(_date("1990-01-01"), (k % 3650).cast("int"))
        ).alias("created_date"),
        F.when(machinery, F.lit("CORPORATE")).otherwise(F.lit("RETAIL")).alias("account_type"),
        F.when(_hit(k, 7, clean), F.lit("  "))
        .when(_hit(k, 11, clean), F.lit(None))
        .otherwise(F.col("c_name"))
        .alias("company_name"),
        (~closed & ~_hit(k, 137, clean)).alias("is_current"),
        F.when(closed, F.date_sub(opened, 200)).otherwise(opened).alias("effective_start_date"),
        F.when(~closed, _date(OPEN_END))
        .when(_hit(k, 61, clean), F.lit(None))
        .when(_hit(k, 67, clean), F.date_sub(opened, 5))
        .otherwise(opened)
        .alias("effective_end_date"),
        F.when(closed, F.lit("B_hist")).otherwise(F.col("_batch_id")).alias("_batch_id"),
    )


def bronze_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    total = F.col("o_totalprice").cast("decimal(18,2)")
    status = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(status == "F", F.lit("SHIPPED"))
        .when(status == "P", F.lit("CANCELLED"))
        .otherwise(F.lit("OPEN"))
        .alias("status"),
        total.alias("order_total"),
        (total * F.lit("0.08").cast("decimal(3,2)")).alias("tax_amount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.concat(F.lit("B"), (F.col("o_orderkey") % 4).cast("string")).alias("_batch_id"),
    )


def silver_order(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    raw, k, d = bronze_order(spark, sf_dir), F.col("order_id"), F.col("order_date")
    rows = raw.where(~_hit(k, 101, clean)).withColumn(
        "version", _versions(closed=k % 3 == 0, current=F.lit(True), extra=_hit(k, 103, clean))
    )
    closed, extra = F.col("version") == "closed", F.col("version") == "extra"
    total, cancelled = F.col("order_total"), F.col("status") == "CANCELLED"
    zeroed = cancelled & (F.lit(True) if clean else k % 10 != 0)
    shipped = (F.col("status") == "SHIPPED") & ~_hit(k, 97, clean)
    return rows.select(
        k,
        F.when(extra, F.col("customer_id"))
        .when(_hit(k, 139, clean), -F.col("customer_id") - 1)
        .when(_hit(k, 149, clean), F.lit(None))
        .otherwise(F.col("customer_id"))
        .alias("customer_id"),
        d,
        "status",
        F.when(extra, total)
        .when(_hit(k, 151, clean), -total)
        .when(zeroed, F.lit(0).cast("decimal(18,2)"))
        .otherwise(total)
        .cast("decimal(18,2)")
        .alias("order_total"),
        "tax_amount",
        F.when(extra | shipped, F.date_add(d, 3)).alias("ship_date"),
        F.when(closed, d)
        .when(extra, F.date_add(d, 60))
        .when(_hit(k, 113, clean), F.lit(None))
        .when(k % 3 == 0, F.date_add(d, 30))
        .otherwise(d)
        .alias("effective_start_date"),
        F.when(~closed, _date(OPEN_END))
        .when(_hit(k, 127, clean), F.lit(None))
        .when(_hit(k, 107, clean), F.date_add(d, 40))
        .when(_hit(k, 109, clean), F.date_add(d, 20))
        .when(_hit(k, 131, clean), F.date_sub(d, 1))
        .otherwise(F.date_add(d, 30))
        .alias("effective_end_date"),
        F.when(closed, F.lit(False))
        .when(extra, F.lit(True))
        .otherwise(~_hit(k, 137, clean))
        .alias("is_current"),
        F.when(closed, F.lit("B_hist")).otherwise(F.col("_batch_id")).alias("_batch_id"),
    )


def bronze_order_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return (
        li.groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"))
        .agg(
            F.min("l_partkey").alias("product_id"),
            F.max("l_quantity").alias("quantity"),
            F.max("l_extendedprice").cast("decimal(18,2)").alias("line_total"),
            F.min(F.col("l_shipdate").cast("date")).alias("ship_date"),
        )
        .withColumn("_batch_id", F.concat(F.lit("B"), (F.col("order_id") % 4).cast("string")))
    )


def silver_order_line(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    raw, k, d = bronze_order_line(spark, sf_dir), F.col("order_id"), F.col("ship_date")
    rows = raw.where(~(_hit(k, 89, clean) & (F.col("line_number") == 1))).withColumn(
        "version", _versions(closed=(k + F.col("line_number")) % 5 == 0, current=F.lit(True))
    )
    closed = F.col("version") == "closed"
    price = F.col("line_total") * F.lit("0.10").cast("decimal(3,2)")
    return rows.select(
        k,
        "line_number",
        "product_id",
        F.when(_hit(k, 157, clean), F.lit(0.0))
        .when(_hit(k, 163, clean), F.lit(10001.0))
        .otherwise(F.col("quantity"))
        .alias("quantity"),
        F.when(_hit(k, 167, clean), F.lit(None))
        .when(_hit(k, 173, clean), -price)
        .otherwise(price)
        .alias("unit_price"),
        "line_total",
        (~closed).alias("is_current"),
        F.when(closed, F.date_sub(d, 30)).otherwise(d).alias("effective_start_date"),
        F.when(~closed, _date(OPEN_END))
        .when(_hit(k, 179, clean), F.date_add(d, 10))
        .when(_hit(k, 181, clean), F.date_sub(d, 5))
        .otherwise(d)
        .alias("effective_end_date"),
        F.when(closed, F.lit("B_hist")).otherwise(F.col("_batch_id")).alias("_batch_id"),
    )


def tables(spark: SparkSession, sf_dir: str, clean: bool = False) -> FrameTables:
    return FrameTables(
        {
            "customer": bronze_customer(spark, sf_dir),
            "order": bronze_order(spark, sf_dir),
            "order_line": bronze_order_line(spark, sf_dir),
        },
        {
            "customer": silver_customer(spark, sf_dir, clean),
            "order": silver_order(spark, sf_dir, clean),
            "order_line": silver_order_line(spark, sf_dir, clean),
        },
    )


def source(spark: SparkSession, sf_dir: str) -> FrameSource:
    orders = bronze_order(spark, sf_dir).select(
        F.col("order_id").alias("OrderID"),
        F.col("order_total").alias("OrderTotal"),
        F.col("tax_amount").alias("TaxAmount"),
    )
    return FrameSource({"dbo.Customer": bronze_customer(spark, sf_dir), "dbo.SalesOrder": orders})


def check_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A check log with a row per event; a run is an hour of one tier."""
    e, tier = read(spark, sf_dir, "events"), (F.col("user_id") % 4 + 1).cast("tinyint")
    i, at = F.col("event_id"), F.col("ts").cast("timestamp")
    by_tier = {n: (t.name, t.category.value, t.severity.value) for n, t in TIERS.items()}

    def named(position: int) -> Column:
        out = F.lit(by_tier[RECON.number][position])
        for n in (3, 2, 1):
            out = F.when(tier == n, F.lit(by_tier[n][position])).otherwise(out)
        return out

    status = F.when(i % 10 == 0, F.lit("FAIL")).when((i % 10).isin(1, 2), F.lit("WARN")).otherwise(F.lit("PASS"))
    bad = i % 10 <= 2
    return e.select(
        F.concat(F.lit("c"), i.cast("string")).alias("check_id"),
        F.concat(F.date_format(at, "yyyy-MM-dd-HH"), F.lit("-"), tier.cast("string")).alias("run_id"),
        F.date_format(at, "yyyy-MM-dd-HH").alias("pipeline_run_id"),
        F.concat(F.lit("B"), (i % 4).cast("string")).alias("batch_id"),
        at.alias("checked_at"),
        tier.alias("tier"),
        named(0).alias("tier_name"),
        F.lit("order").alias("table_name"),
        F.concat(F.lit("order."), "event_type").alias("check_name"),
        named(1).alias("check_category"),
        F.concat(F.lit("check of "), "event_type").alias("check_description"),
        status.alias("status"),
        named(2).alias("severity"),
        F.lit(100.0).alias("expected_value"),
        (i % 13 + 100).cast("double").alias("actual_value"),
        (i % 13).cast("double").alias("variance_value"),
        ((i % 1000).cast("double") / 7.0).alias("variance_pct"),
        F.when(bad, i % 7 + 1).otherwise(F.lit(0)).cast("bigint").alias("failure_count"),
        F.when(bad, F.concat(F.lit('[{"event_id":'), i.cast("string"), F.lit("}]"))).alias("failure_sample"),
        F.concat(F.lit("SELECT "), "event_type").alias("sql_query"),
        (i % 997).cast("bigint").alias("execution_ms"),
        F.to_date(at).alias("check_date"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that were ordered, as a parent without a registry entry; those that end in 0 are not current."""
    parts = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id")).distinct()
    return parts.withColumn("is_current", F.col("product_id") % 10 != 0)


def run_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rows written when each run opened, and rows written when it ended."""
    log = check_log(spark, sf_dir)
    by = ["run_id", "pipeline_run_id", "tier", "tier_name"]
    times = log.groupBy("run_id").agg(
        F.min("checked_at").alias("started_at"),
        F.max("checked_at").alias("completed_at"),
        F.min("batch_id").alias("batch_id"),
    )
    ended = (
        run_summary(log, by)
        .join(times, "run_id")
        .select(
            "run_id",
            "pipeline_run_id",
            "batch_id",
            F.lit("ALL").alias("table_name"),
            "tier",
            "tier_name",
            "started_at",
            "completed_at",
            "status",
            *[F.col(c).cast("int").alias(c) for c in ("total_checks", "passed_checks", "failed_checks", "warned_checks")],
            F.lit(None).cast("string").alias("error_message"),
            F.lit("workload").alias("run_by"),
            F.lit("test").alias("env"),
        )
    )
    opened = times.join(log.select(*by).distinct(), "run_id").select(
        "run_id",
        "pipeline_run_id",
        "batch_id",
        F.lit("ALL").alias("table_name"),
        "tier",
        "tier_name",
        "started_at",
        F.lit(None).cast("timestamp").alias("completed_at"),
        F.lit("RUNNING").alias("status"),
        *[F.lit(None).cast("int").alias(c) for c in ("total_checks", "passed_checks", "failed_checks", "warned_checks")],
        F.lit(None).cast("string").alias("error_message"),
        F.lit("workload").alias("run_by"),
        F.lit("test").alias("env"),
    )
    return opened, ended


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reconciliation snapshot per day and event type; every 50th event never arrived."""
    e = read(spark, sf_dir, "events")
    value = F.col("value").cast("decimal(18,2)")
    arrived = F.when(F.col("event_id") % 50 != 0, value)
    sums = e.groupBy(F.col("ts").cast("date").alias("snapshot_date"), "event_type").agg(
        F.coalesce(F.sum(value), F.lit(0)).cast("double").alias("source_value"),
        F.coalesce(F.sum(arrived), F.lit(0)).cast("double").alias("silver_value"),
    )
    variance = F.col("silver_value") - F.col("source_value")
    pct = F.when(F.col("source_value") == 0, F.lit(0.0)).otherwise(variance / F.col("source_value") * 100)
    return sums.select(
        F.concat(F.col("snapshot_date").cast("string"), F.lit("-"), "event_type").alias("snapshot_id"),
        F.col("snapshot_date").cast("string").alias("run_id"),
        "snapshot_date",
        F.lit("order").alias("table_name"),
        F.concat(F.lit("sum_"), "event_type").alias("metric_name"),
        "source_value",
        "silver_value",
        variance.alias("variance_value"),
        pct.alias("variance_pct"),
        (F.abs(pct) <= 1.0).alias("within_threshold"),
        F.lit(1.0).alias("threshold_pct"),
    )

"""Business rules as ``Column`` expressions.

All rules are built-in Spark expressions, so they stay inside whole-stage
codegen.  Money stays decimal until a rule multiplies it by a ratio; ratios
are doubles.  Divisions that can meet a zero denominator use ``try_divide``
(null instead of an ANSI error).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from costlens.params import Params

HALF = Decimal("0.5")

# Vocabulary of the cost source that the rules test against.
RUNNING = "running"
PRODUCT_ALL_PURPOSE = "ALL_PURPOSE"
PRODUCT_JOBS = "JOBS"
WORKLOAD_JOB_RUNS = "jobRuns"
WORKLOAD_IDLE = "idleWorkloads"
SKU_SERVERLESS_LIKE = "%serverl%"
SKU_SQL_LIKE = "%SQL%"
SKU_SERVERLESS_SQL_LIKE = "%SERVERLESS%"
STATUS_FAILED = "failed"
STATUS_SUCCESS = "success"


# E1 ---------------------------------------------------------------------------
def normalized_status(terminal: Column, command: Column, pipeline: Column) -> Column:
    """Lower-cased workload status.

    A run still 'running' reports its command status; otherwise the terminal
    state, else the command status, else the pipeline state (may be null).
    """
    return (
        F.when(F.lower(terminal) == RUNNING, F.lower(command))
        .when(terminal.isNotNull(), F.lower(terminal))
        .when(command.isNotNull(), F.lower(command))
        .otherwise(F.lower(pipeline))
    )


# E2-E4 ----------------------------------------------------------------------
def is_failed(status: Column, p: Params) -> Column:
    """True for failure statuses; a null status counts as success."""
    return F.coalesce(status.isin(*p.failure_statuses), F.lit(False))


def job_status(status: Column, p: Params) -> Column:
    return F.when(is_failed(status, p), STATUS_FAILED).otherwise(STATUS_SUCCESS)


def half_up(money: Column, scale: int = 2) -> Column:
    """Round a decimal amount half-up (exact; no binary float involved)."""
    return F.round(money, scale)


def failed_revenue_half(status: Column, revenue: Column, p: Params) -> Column:
    """Half of a failed run's revenue, else 0."""
    return F.when(is_failed(status, p), half_up(revenue * F.lit(HALF))).otherwise(0)


def revenue_after_failures(status: Column, revenue: Column, p: Params) -> Column:
    """Revenue kept if failures were halved."""
    return F.when(is_failed(status, p), half_up(revenue * F.lit(HALF))).otherwise(half_up(revenue))


# E5-E9 ----------------------------------------------------------------------
def _all_purpose(product: Column, sku: Column, workload_name: Column, kind: str) -> Column:
    return (product == PRODUCT_ALL_PURPOSE) & ~sku.ilike(SKU_SERVERLESS_LIKE) & (workload_name == kind)


def idle_revenue(product: Column, sku: Column, workload_name: Column, revenue: Column) -> Column:
    """E5: idle all-purpose, non-serverless revenue (rounded), else 0."""
    return F.when(
        _all_purpose(product, sku, workload_name, WORKLOAD_IDLE), half_up(revenue)
    ).otherwise(0)


def _tiered(sku: Column, revenue: Column, p: Params, pick: int, other: Column) -> Column:
    expr = None
    for skus, at_risk, kept in p.sku_tiers:
        factor = F.lit(at_risk if pick == 1 else kept)
        branch = half_up(revenue * factor)
        expr = (F.when if expr is None else expr.when)(sku.isin(*skus), branch)
    return expr.otherwise(other)


def tiered_interactive_risk(
    product: Column, sku: Column, workload_name: Column, revenue: Column, p: Params
) -> Column:
    """At-risk share of interactive job revenue by SKU tier."""
    return F.when(
        _all_purpose(product, sku, workload_name, WORKLOAD_JOB_RUNS), _tiered(sku, revenue, p, 1, F.lit(0))
    ).otherwise(0)


def tiered_corrected_revenue(
    product: Column, sku: Column, workload_name: Column, revenue: Column, p: Params
) -> Column:
    """Interactive job revenue after the tier correction."""
    rounded = half_up(revenue)
    return F.when(
        _all_purpose(product, sku, workload_name, WORKLOAD_JOB_RUNS), _tiered(sku, revenue, p, 2, rounded)
    ).otherwise(rounded)


def sql_compute(sku: Column) -> Column:
    """SQL SKU flag."""
    return sku.ilike(SKU_SQL_LIKE)


def serverless_sql_compute(sku: Column) -> Column:
    """Serverless SQL SKU flag."""
    return sku.ilike(SKU_SQL_LIKE) & sku.ilike(SKU_SERVERLESS_SQL_LIKE)


# E10-E11 ------------------------------------------------------------------------
def flat_penalty(product: Column, p: Params, null_product: bool = False) -> Column:
    """Flat penalty for non-JOBS products (null product -> 0).

    ``null_product=True`` is variant E10b: a null product gives null.
    """
    pen = F.lit(float(p.flat_penalty))
    if null_product:
        return F.when(product == PRODUCT_JOBS, F.lit(0.0)).when(product != PRODUCT_JOBS, pen)
    return F.when(product != PRODUCT_JOBS, pen).otherwise(F.lit(0.0))


def interactive_risk(penalty: Column, revenue: Column) -> Column:
    """E11."""
    return penalty * revenue


# E12-E16 ------------------------------------------------------------------------
def cpu_utilization(user_pct: Column, system_pct: Column) -> Column:
    """E12."""
    return user_pct + system_pct


def cost_share(part: Column, other: Column) -> Column:
    """Part / (part + other); null when the sum is zero."""
    return F.try_divide(part, part + other)


def cost_weighted(worker: Column, worker_share: Column, driver: Column, driver_share: Column) -> Column:
    """W * share_w + d * share_d (null if either side is null)."""
    return worker * worker_share + driver * driver_share


def network_gb(driver_bytes: Column, worker_bytes: Column) -> Column:
    """(driver + worker bytes) / 1e9 as double."""
    return (driver_bytes + worker_bytes).cast("double") / F.lit(1e9)


# E17-E21 ------------------------------------------------------------------------
def utilization_penalty(cpu: Column, mem: Column, p: Params, average: bool = True) -> Column:
    """Mean CPU and memory shortfall below the thresholds.

    ``greatest`` skips nulls, so a null utilization gives no penalty.
    ``average=False`` is variant E17b (sum, range 0-2).
    """
    c, m = p.cpu_threshold, p.mem_threshold
    total = F.greatest(F.lit(c) - cpu, F.lit(0)) / F.lit(c) + F.greatest(
        F.lit(m) - mem, F.lit(0)
    ) / F.lit(m)
    return total / F.lit(2) if average else total


def revenue_at_risk_utilization(revenue: Column, u: Column) -> Column:
    """E18."""
    return revenue * u


def revenue_at_risk_all_purpose(revenue: Column, penalty: Column, u: Column) -> Column:
    """Penalty applied to the revenue left after the utilization risk."""
    return penalty * (revenue - revenue * u)


def revenue_at_risk(revenue: Column, penalty: Column, u: Column) -> Column:
    """Combined risk rev * (p + u - p*u) (= E18 + E19)."""
    return revenue * (penalty + u - penalty * u)


def revenue_at_risk_product(
    revenue: Column, interactive: Column, utilization: Column, post_failure: Column
) -> Column:
    """Literal newer-pipeline product form (dollars times dollars)."""
    return revenue * (interactive + utilization + post_failure)


# E22-E26 ------------------------------------------------------------------------
def ratio(num: Column, den: Column) -> Column:
    """Tasks / slots, null for a zero or null denominator."""
    return F.try_divide(num, den)


def gap_pct(unit: Column, account: Column) -> Column:
    """(unit - account) / unit when the unit is at or above the account."""
    return F.when(unit >= account, F.coalesce(F.try_divide(unit - account, unit), F.lit(0.0))).otherwise(
        F.lit(0.0)
    )


def gap_dollars(unit: Column, account: Column, sql_dollars: Column) -> Column:
    """E24."""
    return F.when(
        unit >= account, F.coalesce(F.try_divide(unit - account, unit), F.lit(0.0)) * sql_dollars
    ).otherwise(F.lit(0.0))


def gap_dollars_revised(unit: Column, account: Column, sql_dollars: Column) -> Column:
    """(sql dollars * unit) * gap."""
    return F.when(
        unit >= account,
        (sql_dollars * unit) * F.coalesce(F.try_divide(unit - account, unit), F.lit(0.0)),
    ).otherwise(F.lit(0.0))


def total_risk(interactive: Column, idle: Column, gap: Column, failed: Column) -> Column:
    """Sum of the four risks (null if any term is null)."""
    return interactive + idle + gap + failed


def adjusted_usage(corrected: Column, idle: Column, gap: Column, failed: Column) -> Column:
    """Corrected usage minus idle, gap and failure risk."""
    return corrected - (idle + gap + failed)

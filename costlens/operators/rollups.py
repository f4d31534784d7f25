"""Aggregations F1, F2, F5-F12.

All are ``groupBy().agg()`` with decomposable aggregates, so Spark runs a
partial (map-side) aggregate before the shuffle.  Distinct runs are kept as bitmaps,
which merge like sums do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.functions import rules
from costlens.functions.exact import exact_parts, exact_total, part_names

# The eleven account dimensions of the account branch.
ACCOUNT_DIMS = (
    "date",
    "industry",
    "bu",
    "region",
    "bu_1",
    "bu_2",
    "bu_3",
    "account_name",
    "platform_account_name",
    "workspace_name",
    "account_owner",
)

# F5-F7 group keys.
ACCOUNT_DAY_KEYS = ("account_id", "account_name", "bu", "region", "bu_1", "bu_2", "bu_3", "date")
WORKSPACE_DAY_KEYS = (
    "account_id",
    "account_name",
    "workspace_name",
    "bu",
    "region",
    "bu_1",
    "bu_2",
    "bu_3",
    "date",
    "workspace_id",
)
JOB_DAY_KEYS = (
    "account_id",
    "account_name",
    "workspace_name",
    "workspace_id",
    "bu",
    "region",
    "bu_1",
    "bu_2",
    "bu_3",
    "date",
    "job_id",
)


# F1 + D9 ---------------------------------------------------------------------
def workload_usage_daily(usage: DataFrame, mapping: DataFrame) -> DataFrame:
    """Daily usage per (date, sku, workload type, workspace) with account dims.

    The mapping has one row per day; only the distinct workspace dimensions are
    joined (X4), so an aggregate row is not repeated once per mapping date.
    """
    agg = usage.groupBy("date", "sku", "workload_type", "workspace_id").agg(
        F.count("cluster_id").alias("cluster_id_count"),
        F.avg("memory_per_node_mb").alias("avg_memory_per_node_mb"),
        F.avg("cpus_per_node").alias("avg_num_cpus_per_node"),
        F.sum("cost_units").alias("sum_cost_units"),
    )
    dims = mapping.select(
        "workspace_id", "bu", "bu_1", "bu_2", "bu_3", "workspace_name", "account_name"
    ).distinct()
    return agg.join(dims, ["workspace_id"], "left")


# F2 ---------------------------------------------------------------------------
def warehouse_tasks_daily(metrics: DataFrame) -> DataFrame:
    """Active tasks and task slots per (date, workspace, serverless)."""
    return metrics.groupBy("date", "workspace_id", "serverless").agg(
        F.sum("active_tasks").alias("active_tasks"),
        F.sum("task_slots").alias("task_slots"),
    )


# F5-F7 --------------------------------------------------------------------------
# A cost line of a run stands for ``copies`` rows of the per-run risk table, one per usage
# and settings line of the run.  The rows here are not copied: every sum weighs a line by
# its copies, and the run's number is a bit that is set once.
_COPIES = "decimal(9,0)"
# rows' column -> (name of the parts' sum, type the sum is taken in)
_RISK_SUMS = {
    "duration_seconds": ("total_duration_seconds", "bigint"),
    "attributed_revenue": ("revenue", "decimal(18,4)"),
    "rev_at_risk": ("total_revenue_at_risk", "decimal(28,10)"),
    "rev_at_risk_utilization": ("revenue_at_risk_utilization", "decimal(28,10)"),
    "rev_at_risk_all_purpose": ("revenue_at_risk_all_purpose_jobs", "decimal(28,10)"),
}
_RISK_MEANS = (
    "avg_cluster_cpu_utilization",
    "avg_cluster_mem_used_percent",
    "avg_cluster_network_gb_sent",
    "avg_cluster_network_gb_received",
)


def _network_gb(direction: str) -> Column:
    """``total_network_gb_*`` of a run."""
    return rules.network_gb(
        F.col(f"sum_d_network_{direction}_bytes"), F.col(f"sum_w_network_{direction}_bytes")
    )


def _weighted() -> list[Column]:
    """The sums of the cost lines, each weighing its copies; means as parts of an exact
    sum, which is the same in any order of rows, and count."""
    copies, weight = F.col("copies"), F.col("copies").cast(_COPIES)
    out = []
    for c, (name, kind) in _RISK_SUMS.items():
        times = copies if kind == "bigint" else weight
        out.append(F.sum(F.col(c).cast(kind) * times).alias(name))
    values = (F.col(_RISK_MEANS[0]), F.col(_RISK_MEANS[1]), _network_gb("sent"), _network_gb("received"))
    for name, x in zip(_RISK_MEANS, values):
        out += [
            *exact_parts(x, f"sum_{name}", copies),
            F.sum(F.when(x.isNotNull(), copies)).alias(f"n_{name}"),
        ]
    return out


def risk_rollup(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duration, utilization averages, distinct runs and risk dollars per group of the
    cost lines ``rows``, each counted ``copies`` times."""
    runs = F.count_distinct("run_id").alias("job_run_count")
    return _rolled(rows.groupBy(*keys).agg(runs, *_weighted()), keys)


def risk_parts(rows: DataFrame) -> DataFrame:
    """Mergeable parts of the risk rollups per job-day: sums, and runs as bitmaps.

    ``rows`` are those of ``risk_rollup`` with ``run_no``, the run id's number.  A part
    holds the runs of one block of numbers as bits, so that parts of different jobs and
    workspaces merge to exact distinct counts.
    """
    runs = F.bitmap_construct_agg(F.bitmap_bit_position("run_no")).alias("runs")
    block = F.bitmap_bucket_number("run_no").alias("run_block")
    return rows.groupBy(*JOB_DAY_KEYS, block).agg(runs, *_weighted())


def _sums() -> list[Column]:
    names = [name for name, _ in _RISK_SUMS.values()]
    names += [n for m in _RISK_MEANS for n in (*part_names(f"sum_{m}"), f"n_{m}")]
    return [F.sum(n).alias(n) for n in names]


def merged_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of job-days (or of any finer keys) merged to ``keys``, block by block."""
    return parts.groupBy(*keys, "run_block").agg(F.bitmap_or_agg("runs").alias("runs"), *_sums())


def parts_rollup(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``risk_rollup`` from the parts of ``keys``: one per group and block of runs."""
    runs = F.sum(F.bitmap_count("runs")).alias("job_run_count")
    return _rolled(parts.groupBy(*keys).agg(runs, *_sums()), keys)


def _rolled(total: DataFrame, keys: Sequence[str]) -> DataFrame:
    def mean(name: str) -> Column:
        return F.try_divide(exact_total(f"sum_{name}"), F.col(f"n_{name}")).alias(name)

    return total.select(
        *keys,
        "total_duration_seconds",
        *[mean(m) for m in _RISK_MEANS],
        "job_run_count",
        F.col("revenue").cast("decimal(28,4)").alias("revenue"),
        "total_revenue_at_risk",
        "revenue_at_risk_utilization",
        "revenue_at_risk_all_purpose_jobs",
    )


RISK_LEVELS = {"account": ACCOUNT_DAY_KEYS, "workspace": WORKSPACE_DAY_KEYS, "job": JOB_DAY_KEYS}


def risk_levels(parts: DataFrame) -> DataFrame:
    """The three rollups in one table, with the level's name; keys of finer levels are null.

    Account-days are merged from the parts of workspace-days, those from job-days.
    """
    by_workspace = merged_parts(parts, WORKSPACE_DAY_KEYS)
    sources = {"job": parts, "workspace": by_workspace, "account": merged_parts(by_workspace, ACCOUNT_DAY_KEYS)}
    out = None
    for level, keys in RISK_LEVELS.items():
        rolled = parts_rollup(sources[level], keys)
        finer = [
            F.lit(None).cast(parts.schema[k].dataType).alias(k) for k in JOB_DAY_KEYS if k not in keys
        ]
        rows = rolled.select(F.lit(level).alias("level"), *rolled.columns, *finer)
        out = rows if out is None else out.unionByName(rows)
    return out


# F8-F11 -----------------------------------------------------------------------
# cost-core column -> output total.  The output names of the account tables (these, the
# dat_/dts_ sums, and those selected in plans/pipeline.py) are fixed values: the published
# column names that readers of these tables use.
COST_TOTALS = {
    "idle_revenue": "idle_revenue",
    "all_purpose_job_revenue": "interactive_risk_dollars",
    "corrected_all_purpose_job_revenue": "interactive_usage_dollar_adjusted_100pct",
    "rounded_revenue": "usage_amount",
    "failed_revenue_half": "failed_workload_risk_dollars",
    "revenue_after_failures": "failed_workload_usage_dollar_adjusted_50pct",
}
_AFTER_FAILURES = COST_TOTALS["revenue_after_failures"]
_MONEY = "decimal(38,2)"


def account_day_units(core: DataFrame) -> DataFrame:
    """Cost rows summed per account dimensions, workspace and serverless flag: the
    one pass over the cost rows that F8-F10 are all derived from."""
    sql = F.col("sql_compute") == F.lit(True)
    return core.groupBy(*ACCOUNT_DIMS, "workspace_id", "serverless_sql_compute").agg(
        *[F.sum(c).cast(_MONEY).alias(out) for c, out in COST_TOTALS.items()],
        F.sum(F.when(sql, F.col("rounded_revenue"))).cast(_MONEY).alias("sql_dollars"),
        F.count_if(sql).alias("n_sql"),
    )


def account_day(units: DataFrame, tasks: DataFrame, weight: str) -> DataFrame:
    """F8 and the SQL sums of D13/F10 per account dimensions.

    Every SQL cost row carries its day's warehouse totals (literal weighting,
    X5), so a unit with n SQL rows counts them n times; with ``weight="none"``
    it counts them once.
    """
    h = tasks.select(
        F.col("date").alias("h_date"),
        F.col("workspace_id").alias("h_workspace_id"),
        F.col("serverless").alias("h_serverless"),
        "active_tasks",
        "task_slots",
    )
    j = units.join(
        h,
        (units["date"] == h["h_date"])
        & (units["workspace_id"] == h["h_workspace_id"])
        & (units["serverless_sql_compute"] == h["h_serverless"])
        & (units["n_sql"] > 0),
        "left",
    )
    times = F.col("n_sql") if weight == "cost_rows" else F.lit(1)
    return j.groupBy(*ACCOUNT_DIMS).agg(
        *[F.sum(c).cast(_MONEY).alias(c) for c in (*COST_TOTALS.values(), "sql_dollars")],
        F.sum("n_sql").alias("n_sql"),
        F.sum(F.col("active_tasks") * times).alias("dat_acnt"),
        F.sum(F.col("task_slots") * times).alias("dts_acnt"),
    )


def account_cost_totals(days: DataFrame) -> DataFrame:
    """F8: six dollar totals per account dimensions (the sixth is dropped later, X12)."""
    return days.select(*ACCOUNT_DIMS, *COST_TOTALS.values())


def unit_totals(days: DataFrame) -> DataFrame:
    """tasks and slots per (date, business unit); (date, bu_1) is among the dims."""
    return days.where("n_sql > 0").groupBy("date", "bu_1").agg(
        F.sum("dat_acnt").alias("dat_bu1"), F.sum("dts_acnt").alias("dts_bu1")
    )


def with_unit_totals(days: DataFrame) -> DataFrame:
    """The day's unit totals on each account row.

    The totals, a row per (date, bu_1) summed with map-side partials, are joined to
    the account rows, so a unit that holds most accounts is not gathered in one task:
    adaptive execution broadcasts the totals or splits the unit.  Null keys get none.
    """
    totals = unit_totals(days).select(
        F.col("date").alias("unit_date"), F.col("bu_1").alias("unit_bu_1"), "dat_bu1", "dts_bu1"
    )
    same = (days["date"] == totals["unit_date"]) & (days["bu_1"] == totals["unit_bu_1"])
    return days.join(totals, same, "left").select(*days.columns, "dat_bu1", "dts_bu1")


def account_totals(days: DataFrame) -> DataFrame:
    """per-account SQL sums with the day's unit totals."""
    cols = ["dat_bu1", "dts_bu1", "dat_acnt", "dts_acnt", "sql_dollars"]
    return with_unit_totals(days).where("n_sql > 0").select(*ACCOUNT_DIMS, *cols)


def cost_and_util(days: DataFrame) -> DataFrame:
    """D15 + F11: cost totals with SQL utilization.

    The reference joins both sides on all dimensions, so a row with a null
    dimension, or without SQL cost rows, has no utilization; its totals are
    unique per dimensions, so the re-aggregation changes nothing.
    """
    met = F.col("n_sql") > 0
    for d in ACCOUNT_DIMS:
        met = met & F.col(d).isNotNull()
    sql_side = ["dat_bu1", "dts_bu1", "dat_acnt", "dts_acnt", "sql_dollars"]
    *dollars, failed = [c for c in COST_TOTALS.values() if c != _AFTER_FAILURES]
    return with_unit_totals(days).select(
        *ACCOUNT_DIMS, *dollars, *[F.when(met, F.col(c)).alias(c) for c in sql_side], failed
    )


# F12 --------------------------------------------------------------------------
def warehouse_daily(metrics: DataFrame) -> DataFrame:
    """Daily warehouse summary; type and serverless flag of the earliest sample.

    Samples without timestamp are never the earliest; ties are broken by value,
    so the result does not depend on partitioning.  The samples are hash-
    aggregated per type and flag first; only those few rows are compared.
    """
    key = ["date", "warehouse_id", "workspace_id"]
    means = ["executors_total", "executors_active", "pending_tasks"]
    kinds = metrics.groupBy(*key, "warehouse_type", "serverless").agg(
        F.min("ts").alias("ts"),
        F.sum("active_tasks").alias("active_tasks"),
        F.sum("task_slots").alias("task_slots"),
        *[x for m in means for x in (F.sum(m).alias(f"sm_{m}"), F.count(m).alias(f"n_{m}"))],
    )
    timed = F.col("ts").isNotNull()

    def earliest(c: str):
        return F.min(F.when(timed, F.struct("ts", c)))[c].alias(c)

    def mean(m: str):
        return F.try_divide(F.sum(f"sm_{m}").cast("double"), F.sum(f"n_{m}")).alias(f"avg_{m}")

    return kinds.groupBy(*key).agg(
        earliest("warehouse_type"),
        earliest("serverless"),
        F.sum("active_tasks").alias("active_tasks"),
        F.sum("task_slots").alias("task_slots"),
        *[mean(m) for m in means],
    )

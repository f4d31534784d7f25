"""Source adapters: typed logical source -> narrowed, renamed, date-bounded frame.

Each adapter is ``(DataFrame, Params) -> DataFrame``.  The date bound is a
plain comparison of the source column with a date literal, so Catalyst pushes
it to the parquet scan (for ``cast(start_time as date) >= d`` it rewrites to a
timestamp bound first).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.functions import rules
from costlens.params import Params


def since(df: DataFrame, column: str | Column, bound: _dt.date, strict: bool = False) -> DataFrame:
    """Keep rows whose date column is on/after (or strictly after) ``bound``."""
    c = F.col(column) if isinstance(column, str) else column
    lit = F.lit(bound)
    return df.where(c > lit if strict else c >= lit)


# A1 -------------------------------------------------------------------------
def usage_records(df: DataFrame, p: Params) -> DataFrame:
    """Billing usage lines with a cluster, one row per distinct line."""
    out = df.select(
        F.col("usage_date").alias("date"),
        "account_id",
        "workspace_id",
        F.col("usage_metadata.cluster_id").alias("cluster_id"),
        "sku_name",
        F.col("billing_origin").alias("usage_origin"),
    )
    return since(out, "date", p.start_date).where(F.col("cluster_id").isNotNull()).distinct()


# A2 -------------------------------------------------------------------------
def cluster_configs_narrow(df: DataFrame, p: Params) -> DataFrame:
    """Configuration changes on/after ``change_date``: five columns."""
    return since(df, "change_date", p.change_date).select(
        "cluster_id", "workspace_id", "account_id", "auto_termination_minutes", "change_time"
    )


# A3 -------------------------------------------------------------------------
WIDE_CONFIG_COLUMNS = (
    "cluster_id",
    "cluster_name",
    "create_time",
    "delete_time",
    "driver_node_type",
    "worker_node_type",
    "worker_count",
    "min_autoscale_workers",
    "max_autoscale_workers",
    "auto_termination_minutes",
    "runtime_version",
    "workspace_id",
    "account_id",
    "change_time",
    "change_date",
    "cluster_source",
)


def cluster_configs(df: DataFrame, p: Params) -> DataFrame:
    """Configuration history on/after the start date, all 16 columns."""
    return since(df, "change_date", p.start_date).select(*WIDE_CONFIG_COLUMNS)


# A4-A6 ----------------------------------------------------------------------
METRICS = (
    ("cpu_user_percent", "cpu_user_pct"),
    ("cpu_system_percent", "cpu_system_pct"),
    ("cpu_wait_percent", "cpu_wait_pct"),
    ("mem_used_percent", "mem_used_pct"),
    ("mem_swap_percent", "mem_swap_pct"),
)
BYTES = (
    ("network_received_bytes", "network_received_bytes"),
    ("network_sent_bytes", "network_sent_bytes"),
)


def _timeline(
    df: DataFrame, p: Params, prefix: str, with_instance: bool, with_role: bool = False
) -> DataFrame:
    df = since(df, F.col("start_time").cast("date"), p.start_date)
    cols = [
        F.col("start_time").cast("date").alias("date"),
        "account_id",
        "workspace_id",
        "cluster_id",
    ]
    if with_instance:
        cols.append("instance_id")
    cols += ["start_time", "end_time"]
    cols += [F.col(src).alias(prefix + dst) for src, dst in METRICS]
    cols += [F.col(src).cast("decimal(38,0)").alias(prefix + dst) for src, dst in BYTES]
    if with_role:
        cols.append("driver")
    return df.select(*cols)


def timeline_driver(df: DataFrame, p: Params) -> DataFrame:
    """Driver samples (``driver is true``), columns prefixed ``d_``."""
    return _timeline(df.where(F.col("driver").eqNullSafe(True)), p, "d_", False)


def timeline_worker(df: DataFrame, p: Params) -> DataFrame:
    """Worker samples (``driver is false``), with instance, prefixed ``w_``."""
    return _timeline(df.where(F.col("driver").eqNullSafe(False)), p, "w_", True)


def timeline(df: DataFrame, p: Params) -> DataFrame:
    """All samples with the ``driver`` role flag kept as a column."""
    return _timeline(df, p, "", False, with_role=True)


# A7 -------------------------------------------------------------------------
def job_runs(df: DataFrame, p: Params) -> DataFrame:
    """Runs with derived start, minute-floored start and minute ceiling."""
    start = F.timestamp_add("SECOND", -F.col("duration_seconds"), F.col("termination_time"))
    return since(df, "date", p.start_date).select(
        "date",
        "workspace_id",
        "cluster_id",
        "job_id",
        "run_id",
        start.alias("run_start_time"),
        F.date_trunc("minute", start).alias("run_start_floor"),
        F.timestamp_add("MINUTE", F.lit(1), F.date_trunc("minute", F.col("termination_time"))).alias(
            "run_term_ceil"
        ),
        "duration_seconds",
        "termination_time",
        "terminal_state",
        "cluster_type",
        "task_type",
        "trigger_type",
    )


# A8 / A9 ----------------------------------------------------------------------
def workload_costs(df: DataFrame, p: Params) -> DataFrame:
    """Attributed costs, struct fields flattened, status normalized."""
    return since(df, "date", p.start_date).select(
        "date",
        "cluster_id",
        "workload_id",
        "workspace_id",
        "crm_account_id",
        F.col("tags.job_id").alias("job_id"),
        F.col("tags.run_id").alias("run_id"),
        "workload_name",
        "sku",
        "product_type",
        rules.normalized_status(
            F.col("tags.run_terminal_state"),
            F.col("tags.command_status"),
            F.col("tags.pipeline_state"),
        ).alias("workload_status"),
        "attributed_revenue",
        F.col("attributed.driver_cost_units").alias("driver_cost_units"),
        F.col("attributed.worker_cost_units").alias("worker_cost_units"),
    )


def workload_costs_sql(df: DataFrame, p: Params) -> DataFrame:
    """The same adapter written as SQL expressions, limited to job runs."""
    return (
        since(df, "date", p.start_date)
        .selectExpr(
            "date",
            "cluster_id",
            "workload_id",
            "workspace_id",
            "crm_account_id",
            "tags.job_id AS job_id",
            "tags.run_id AS run_id",
            "workload_name",
            "sku",
            "product_type",
            """CASE
                 WHEN lower(tags.run_terminal_state) = 'running' THEN lower(tags.command_status)
                 WHEN tags.run_terminal_state IS NOT NULL THEN lower(tags.run_terminal_state)
                 WHEN tags.command_status IS NOT NULL THEN lower(tags.command_status)
                 ELSE lower(tags.pipeline_state)
               END AS workload_status""",
            "attributed_revenue",
            "attributed.driver_cost_units AS driver_cost_units",
            "attributed.worker_cost_units AS worker_cost_units",
        )
        .where("job_id IS NOT NULL AND run_id IS NOT NULL")
    )


def costs_with_run(costs: DataFrame) -> DataFrame:
    """Cost rows that belong to a job run."""
    return costs.where(F.col("job_id").isNotNull() & F.col("run_id").isNotNull())


# A10 / A11 ------------------------------------------------------------------
def warehouse_metrics(df: DataFrame, p: Params) -> DataFrame:
    """Warehouse samples strictly after the start date (defect X1 fixed)."""
    return since(df, "date", p.start_date, strict=True).select(
        "date",
        "ts",
        "warehouse_id",
        "workspace_id",
        "warehouse_type",
        "serverless",
        "executors_total",
        "executors_active",
        "active_tasks",
        "task_slots",
        "pending_tasks",
        "at_full_capacity",
    )


# A12 ------------------------------------------------------------------------
MAPPING_COLUMNS = (
    "date",
    "crm_account_id",
    "account_id",
    "workspace_id",
    "workspace_name",
    "industry",
    "bu",
    "region",
    "bu_1",
    "bu_2",
    "bu_3",
    "account_name",
    "platform_account_name",
    "account_owner",
)


def account_mapping(df: DataFrame, p: Params) -> DataFrame:
    """Workspace-to-account dimensions per day, one row per distinct line."""
    return since(df, "date", p.start_date).select(*MAPPING_COLUMNS).distinct()

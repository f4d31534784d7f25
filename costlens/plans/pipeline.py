"""The dataset graph as lazily built, memoized DataFrames.

Each property is one named dataset of SURVEY §3; building a property builds a
plan but runs nothing.  Reusing the same DataFrame object for a dataset read
by several consumers lets Spark reuse its exchanges inside one query.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.functions import rules
from costlens.operators import intervals, rollups, scope, validity
from costlens.params import Params
from costlens.sources import Sources
from costlens.sources import adapters as A

RUN_KEYS = ["date", "workspace_id", "cluster_id", "job_id", "run_id"]
MAPPING_KEY = ["workspace_id", "crm_account_id"]
MAPPING_DIMS = [
    "crm_account_id",
    "account_id",
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
]
COST_COLS = [
    "workload_id",
    "workload_name",
    "sku",
    "product_type",
    "workload_status",
    "attributed_revenue",
    "driver_cost_units",
    "worker_cost_units",
]


def _rename(df: DataFrame, prefix: str, cols) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


def add_utilization(df: DataFrame) -> DataFrame:
    """E12-E16 and the X16 flag on a profiled run frame with cost units."""
    d_share = rules.cost_share(F.col("driver_cost_units"), F.col("worker_cost_units"))
    w_share = rules.cost_share(F.col("worker_cost_units"), F.col("driver_cost_units"))
    df = df.withColumns(
        {
            "avg_worker_cpu_utilization": rules.cpu_utilization(
                F.col("avg_w_cpu_user_pct"), F.col("avg_w_cpu_system_pct")
            ),
            "avg_driver_cpu_utilization": rules.cpu_utilization(
                F.col("avg_d_cpu_user_pct"), F.col("avg_d_cpu_system_pct")
            ),
            "driver_cost_share": d_share,
            "worker_cost_share": w_share,
        }
    )
    w, d = F.col("worker_cost_share"), F.col("driver_cost_share")
    return df.withColumns(
        {
            "worker_weighted_cpu_utilization": F.col("avg_worker_cpu_utilization") * w,
            "driver_weighted_cpu_utilization": F.col("avg_driver_cpu_utilization") * d,
            "avg_cluster_cpu_utilization": rules.cost_weighted(
                F.col("avg_worker_cpu_utilization"), w, F.col("avg_driver_cpu_utilization"), d
            ),
            "avg_cluster_mem_used_percent": rules.cost_weighted(
                F.col("avg_w_mem_used_pct"), w, F.col("avg_d_mem_used_pct"), d
            ),
            "avg_mem_swap_used_percent": rules.cost_weighted(
                F.col("avg_w_mem_swap_pct"), w, F.col("avg_d_mem_swap_pct"), d
            ),
            "avg_cpu_wait_percent": rules.cost_weighted(
                F.col("avg_w_cpu_wait_pct"), w, F.col("avg_d_cpu_wait_pct"), d
            ),
            "total_network_gb_received": rules.network_gb(
                F.col("sum_d_network_received_bytes"), F.col("sum_w_network_received_bytes")
            ),
            "total_network_gb_sent": rules.network_gb(
                F.col("sum_d_network_sent_bytes"), F.col("sum_w_network_sent_bytes")
            ),
            "has_full_profile": F.col("avg_worker_cpu_utilization").isNotNull()
            & F.col("avg_driver_cpu_utilization").isNotNull(),
        }
    )


def add_utilization_risk(df: DataFrame, p: Params, average: bool = True) -> DataFrame:
    """E17-E18."""
    df = df.withColumn(
        "utilization_penalty",
        rules.utilization_penalty(
            F.col("avg_cluster_cpu_utilization"), F.col("avg_cluster_mem_used_percent"), p, average
        ),
    )
    return df.withColumn(
        "rev_at_risk_utilization",
        rules.revenue_at_risk_utilization(F.col("attributed_revenue"), F.col("utilization_penalty")),
    )


def add_run_risk(df: DataFrame, p: Params, null_product: bool = False) -> DataFrame:
    """E10, E19, E20."""
    df = df.withColumn("all_purpose_penalty", rules.flat_penalty(F.col("product_type"), p, null_product))
    rev, pen, u = F.col("attributed_revenue"), F.col("all_purpose_penalty"), F.col("utilization_penalty")
    return df.withColumns(
        {
            "rev_at_risk_all_purpose": rules.revenue_at_risk_all_purpose(rev, pen, u),
            "rev_at_risk": rules.revenue_at_risk(rev, pen, u),
        }
    )


class Pipeline:
    """All datasets over one set of sources and parameters."""

    def __init__(self, sources: Sources, params: Params):
        self.src = sources
        self.p = params

    # -- adapters (A) ----------------------------------------------------------
    @cached_property
    def usage(self) -> DataFrame:
        return A.usage_records(self.src.usage_records, self.p)

    @cached_property
    def configs_narrow(self) -> DataFrame:
        return A.cluster_configs_narrow(self.src.cluster_configs, self.p)

    @cached_property
    def configs(self) -> DataFrame:
        return A.cluster_configs(self.src.cluster_configs, self.p)

    @cached_property
    def timeline_driver(self) -> DataFrame:
        return A.timeline_driver(self.src.node_timeline, self.p)

    @cached_property
    def timeline_worker(self) -> DataFrame:
        return A.timeline_worker(self.src.node_timeline, self.p)

    @cached_property
    def timeline(self) -> DataFrame:
        return A.timeline(self.src.node_timeline, self.p)

    @cached_property
    def job_runs(self) -> DataFrame:
        return A.job_runs(self.src.job_runs, self.p)

    @cached_property
    def costs(self) -> DataFrame:
        return A.workload_costs(self.src.workload_costs, self.p)

    @cached_property
    def costs_sql(self) -> DataFrame:
        return A.workload_costs_sql(self.src.workload_costs, self.p)

    @cached_property
    def costs_with_run(self) -> DataFrame:
        return A.costs_with_run(self.costs)

    @cached_property
    def warehouse(self) -> DataFrame:
        return A.warehouse_metrics(self.src.warehouse_metrics, self.p)

    @cached_property
    def mapping(self) -> DataFrame:
        return A.account_mapping(self.src.account_mapping, self.p)

    @cached_property
    def scope(self) -> DataFrame:
        return scope.scope_workspaces(self.src.workspaces, self.src.excluded_accounts, self.p)

    @cached_property
    def scope_not_in(self) -> DataFrame:
        return scope.scope_not_in(self.src.workspaces, self.src.excluded_accounts, self.p)

    @cached_property
    def workload_usage(self) -> DataFrame:
        return A.since(self.src.workload_cluster_usage, "date", self.p.start_date)

    # -- scope joins (D1-D4) ------------------------------------------------------
    @cached_property
    def runs_scoped(self) -> DataFrame:
        return scope.runs_in_scope(self.job_runs, self.scope)

    @cached_property
    def configs_scoped(self) -> DataFrame:
        return scope.configs_in_scope(self.configs_narrow, self.scope)

    @cached_property
    def mapping_scoped(self) -> DataFrame:
        m = scope.mapping_in_scope(self.mapping, self.scope)
        return A.since(m, "date", self.p.start_date)

    @cached_property
    def mapping_periods(self) -> DataFrame:
        """A12 as validity intervals: the mapping's changes instead of its days."""
        return validity.periods(self.mapping, MAPPING_KEY)

    @cached_property
    def mapping_scoped_periods(self) -> DataFrame:
        """D3 on the intervals: a line is in scope on all its days or on none."""
        return scope.mapping_in_scope(self.mapping_periods, self.scope)

    @cached_property
    def mapping_from_periods(self) -> DataFrame:
        """The daily rows, given back by the intervals."""
        return validity.lines(self.mapping_scoped_periods).select(*self.mapping.columns)

    def _mapping_for(self, costs: DataFrame, scoped: bool) -> DataFrame:
        """The mapping lines that ``costs`` can meet: looked up in the intervals, or per day."""
        if not self.p.mapping_periods:
            return self.mapping_scoped if scoped else self.mapping
        table = self.mapping_scoped_periods if scoped else self.mapping_periods
        return validity.in_force(costs, table, MAPPING_KEY)

    @cached_property
    def warehouse_scoped(self) -> DataFrame:
        return scope.warehouse_in_scope(self.warehouse, self.scope)

    # -- entry A: per-run utilization and risk ------------------------------------------
    def _with_usage(self, runs: DataFrame) -> DataFrame:
        u = self.usage.select("date", "workspace_id", "cluster_id", "usage_origin", "sku_name").distinct()
        out = runs.join(u, ["date", "workspace_id", "cluster_id"], "left")
        return out.select(*runs.columns, "usage_origin", "sku_name")

    def _with_config(self, runs: DataFrame) -> DataFrame:
        c = self.configs_scoped.select("workspace_id", "cluster_id", "auto_termination_minutes").distinct()
        out = runs.join(c, ["workspace_id", "cluster_id"], "left")
        return out.select(*runs.columns, "auto_termination_minutes")

    @cached_property
    def runs_with_usage(self) -> DataFrame:
        """Runs with usage origin and SKU (distinct per run key, X3)."""
        return self._with_usage(self.runs_scoped)

    def _with_copies(self, runs: DataFrame) -> DataFrame:
        """D5/D6 factorised: each run with the number of rows that its usage and settings
        lines fan it out to, instead of those rows."""

        def counted(lines: DataFrame, keys: list[str], prefix: str) -> DataFrame:
            n = lines.distinct().groupBy(*keys).agg(F.count("*").alias("lines"))
            return _rename(n, f"{prefix}_", [*keys, "lines"])

        usage_keys, config_keys = ["date", "workspace_id", "cluster_id"], ["workspace_id", "cluster_id"]
        u = counted(self.usage.select(*usage_keys, "usage_origin", "sku_name"), usage_keys, "usage")
        c = counted(self.configs_scoped.select(*config_keys, "auto_termination_minutes"), config_keys, "config")
        out = runs.join(u, [runs[k] == u[f"usage_{k}"] for k in usage_keys], "left")
        out = out.join(c, [runs[k] == c[f"config_{k}"] for k in config_keys], "left")
        one = F.lit(1).cast("long")
        copies = F.coalesce("usage_lines", one) * F.coalesce("config_lines", one)
        return out.select(*runs.columns, copies.alias("copies"))

    @cached_property
    def run_line_copies(self) -> DataFrame:
        """D5/D6 factorised: rows of ``run_worker_profile`` per distinct run."""
        return self._with_copies(self.runs_scoped.distinct()).select(*RUN_KEYS, "copies")

    @cached_property
    def run_numbers(self) -> DataFrame:
        """A number for each run id, dense within a workspace-day and its jobs.

        Adaptive execution splits a large workspace-day and merges small ones; runs of
        one job follow each other, so their bits share few blocks.
        """
        place = F.min(F.struct("date", "workspace_id", "job_id")).alias("place")
        runs = self.runs_scoped.groupBy("run_id").agg(place)
        runs = runs.select("run_id", "place", "place.date", "place.workspace_id")
        runs = runs.hint("rebalance", "date", "workspace_id").sortWithinPartitions("place", "run_id")
        return runs.select("run_id", F.monotonically_increasing_id().alias("run_no"))

    @cached_property
    def runs_with_config(self) -> DataFrame:
        """Runs with auto-termination settings (whole history, distinct, X3)."""
        return self._with_config(self.runs_with_usage)

    @cached_property
    def timeline_scoped(self) -> DataFrame:
        """Samples of workspaces in scope: runs are scoped, so no other sample can count."""
        return scope.semi(self.timeline, self.scope, ["workspace_id"])

    def _profiled(self, roles: tuple[str, ...]) -> DataFrame:
        """One row per distinct run line (the reference's group-by on all columns).

        The distinct, narrow run rows are profiled first; usage and settings, both
        distinct on their projected columns, fan them out last, so the rows are
        those of the group-by and the joins before carry no copies.
        """
        runs = self.runs_scoped.distinct()
        if "worker" in roles:
            prof = self.run_profile
        else:
            prof = intervals.run_profile(runs, self.timeline_scoped, self.p, roles=roles)
        wide = self._with_config(self._with_usage(prof))
        extra = ["usage_origin", "sku_name", "auto_termination_minutes"]
        return wide.select(*runs.columns, *extra, *intervals.profile_columns(roles))

    @cached_property
    def run_profile(self) -> DataFrame:
        """D7/D8 + F3/F4 before the fan-out: one row per distinct run."""
        return intervals.run_profile(self.runs_scoped.distinct(), self.timeline_scoped, self.p)

    @cached_property
    def run_driver_profile(self) -> DataFrame:
        """D7 + F3."""
        return self._profiled(("driver",))

    @cached_property
    def run_worker_profile(self) -> DataFrame:
        """D8 + F4 on top of the driver profile: the run utilization table."""
        return self._profiled(("driver", "worker"))

    @cached_property
    def run_costs_mapped(self) -> DataFrame:
        """Utilization ⋈ costs (5 keys) ⋈ scoped mapping (date, ws, CRM account).

        Both joins are inner and the mapping condition only reads cost columns,
        so costs are joined to the mapping first: the large utilization side is
        then shuffled once, on the five run keys.
        """
        return self._costs_mapped(self.run_worker_profile)

    def _costs_mapped(self, profiles: DataFrame) -> DataFrame:
        util = A.since(profiles, "date", self.p.start_date)
        costs = _rename(self.costs_with_run, "c_", [*RUN_KEYS, "crm_account_id", *COST_COLS])
        mp = _rename(self._mapping_for(self.costs_with_run, scoped=True), "m_", ["date", "workspace_id", *MAPPING_DIMS])
        cm = costs.join(
            mp,
            (costs["c_date"] == mp["m_date"])
            & (costs["c_workspace_id"] == mp["m_workspace_id"])
            & (costs["c_crm_account_id"] == mp["m_crm_account_id"]),
            "inner",
        )
        j = util.join(cm, [util[k] == cm["c_" + k] for k in RUN_KEYS], "inner")
        return j.select(
            *util.columns,
            *[F.col("c_" + c).alias(c) for c in COST_COLS],
            *[F.col("m_" + c).alias(c) for c in MAPPING_DIMS],
        )

    @cached_property
    def run_utilization_derived(self) -> DataFrame:
        """B17 / E12-E16."""
        return add_utilization(self.run_costs_mapped)

    @cached_property
    def run_utilization_risk(self) -> DataFrame:
        """E17-E18."""
        return add_utilization_risk(
            self.run_utilization_derived, self.p, self.p.average_utilization_penalty
        )

    @cached_property
    def run_risk(self) -> DataFrame:
        """The per-run risk table."""
        return add_run_risk(self.run_utilization_risk, self.p, self.p.null_product_penalty)

    @cached_property
    def _rollup_rows(self) -> DataFrame:
        """The cost lines of runs that the risk rollups sum, each once.

        Literally a line counts once per usage and settings line of its run; ``copies``
        says how often, and the wide rows are never copied.  With ``count_cost_once``
        (X22) each line counts once.
        """
        prof = self.run_profile
        if self.p.count_cost_once:
            prof = prof.withColumn("copies", F.lit(1).cast("long"))
        else:
            prof = self._with_copies(prof)
        derived = add_utilization(self._costs_mapped(prof))
        risk = add_utilization_risk(derived, self.p, self.p.average_utilization_penalty)
        return add_run_risk(risk, self.p, self.p.null_product_penalty)

    @cached_property
    def risk_rollup_account(self) -> DataFrame:
        return rollups.risk_rollup(self._rollup_rows, rollups.ACCOUNT_DAY_KEYS)

    @cached_property
    def risk_rollup_workspace(self) -> DataFrame:
        return rollups.risk_rollup(self._rollup_rows, rollups.WORKSPACE_DAY_KEYS)

    @cached_property
    def risk_rollup_job(self) -> DataFrame:
        return rollups.risk_rollup(self._rollup_rows, rollups.JOB_DAY_KEYS)

    # The same three from one pass: job-days with their runs as bitmaps, merged upwards.
    @cached_property
    def risk_job_parts(self) -> DataFrame:
        """The one pass over the cost lines, mergeable to every level."""
        rows = self._rollup_rows
        numbers = self.run_numbers.select(F.col("run_id").alias("numbered_run"), "run_no")
        rows = rows.join(numbers, rows["run_id"] == numbers["numbered_run"], "left")
        return rollups.risk_parts(rows)

    @cached_property
    def risk_workspace_parts(self) -> DataFrame:
        return rollups.merged_parts(self.risk_job_parts, rollups.WORKSPACE_DAY_KEYS)

    @cached_property
    def merged_rollup_account(self) -> DataFrame:
        parts = rollups.merged_parts(self.risk_workspace_parts, rollups.ACCOUNT_DAY_KEYS)
        return rollups.parts_rollup(parts, rollups.ACCOUNT_DAY_KEYS)

    @cached_property
    def merged_rollup_workspace(self) -> DataFrame:
        return rollups.parts_rollup(self.risk_workspace_parts, rollups.WORKSPACE_DAY_KEYS)

    @cached_property
    def merged_rollup_job(self) -> DataFrame:
        return rollups.parts_rollup(self.risk_job_parts, rollups.JOB_DAY_KEYS)

    @cached_property
    def risk_rollup_levels(self) -> DataFrame:
        """F5-F7 in one table, from one pass."""
        return rollups.risk_levels(self.risk_job_parts)

    # -- entry B: account-level risk -------------------------------------------------------
    @cached_property
    def account_cost_core(self) -> DataFrame:
        """D12 + E2-E9: cost rows with account dims and dollar rules."""
        c, m = self.costs, self._mapping_for(self.costs, scoped=False)
        j = c.join(m, ["date", "workspace_id", "crm_account_id"], "inner")
        j = A.since(j, "date", self.p.start_date)
        prod, sku, name, rev = (
            F.col("product_type"),
            F.col("sku"),
            F.col("workload_name"),
            F.col("attributed_revenue"),
        )
        status = F.col("workload_status")
        return j.select(
            "date",
            "workspace_id",
            "crm_account_id",
            *[d for d in rollups.ACCOUNT_DIMS if d != "date"],
            rules.idle_revenue(prod, sku, name, rev).alias("idle_revenue"),
            rules.tiered_interactive_risk(prod, sku, name, rev, self.p).alias("all_purpose_job_revenue"),
            rules.tiered_corrected_revenue(prod, sku, name, rev, self.p).alias(
                "corrected_all_purpose_job_revenue"
            ),
            rules.half_up(rev).alias("rounded_revenue"),
            rules.sql_compute(sku).alias("sql_compute"),
            rules.serverless_sql_compute(sku).alias("serverless_sql_compute"),
            rules.job_status(status, self.p).alias("job_status"),
            rules.failed_revenue_half(status, rev, self.p).alias("failed_revenue_half"),
            rules.revenue_after_failures(status, rev, self.p).alias("revenue_after_failures"),
        )

    @cached_property
    def warehouse_tasks_daily(self) -> DataFrame:
        return rollups.warehouse_tasks_daily(self.warehouse)

    @cached_property
    def account_days(self) -> DataFrame:
        """Cost and SQL sums per account dimensions: one pass over the cost rows."""
        units = rollups.account_day_units(self.account_cost_core)
        return rollups.account_day(units, self.warehouse_tasks_daily, self.p.weight)

    @cached_property
    def account_cost_totals(self) -> DataFrame:
        """F8."""
        return rollups.account_cost_totals(self.account_days)

    @cached_property
    def warehouse_util_by_unit(self) -> DataFrame:
        """F9."""
        return rollups.unit_totals(self.account_days)

    @cached_property
    def warehouse_util_by_account(self) -> DataFrame:
        """D14 + F10."""
        return rollups.account_totals(self.account_days)

    @cached_property
    def account_cost_and_util(self) -> DataFrame:
        """D15 + F11."""
        return rollups.cost_and_util(self.account_days)

    @cached_property
    def account_util_ratios(self) -> DataFrame:
        """E22."""
        d = self.account_cost_and_util
        return d.select(
            *rollups.ACCOUNT_DIMS,
            rules.ratio(F.col("dat_bu1"), F.col("dts_bu1")).alias("overall_avg_utilization_bu1"),
            rules.ratio(F.col("dat_acnt"), F.col("dts_acnt")).alias("overall_avg_utilization_acnt"),
            "sql_dollars",
            "usage_amount",
            "idle_revenue",
            "interactive_risk_dollars",
            "interactive_usage_dollar_adjusted_100pct",
            "failed_workload_risk_dollars",
        )

    @cached_property
    def account_util_gap(self) -> DataFrame:
        """E23-E25."""
        d = self.account_util_ratios
        unit, acct, dollars = (
            F.col("overall_avg_utilization_bu1"),
            F.col("overall_avg_utilization_acnt"),
            F.col("sql_dollars"),
        )
        return d.select(
            *rollups.ACCOUNT_DIMS,
            "overall_avg_utilization_bu1",
            "overall_avg_utilization_acnt",
            "sql_dollars",
            rules.gap_pct(unit, acct).alias("risk_pct_bu1"),
            rules.gap_dollars(unit, acct, dollars).alias("at_risk_dollars_bu1"),
            rules.gap_dollars_revised(unit, acct, dollars).alias("at_risk_dollars_bu1_revised"),
            "usage_amount",
            "idle_revenue",
            "interactive_risk_dollars",
            "interactive_usage_dollar_adjusted_100pct",
            "failed_workload_risk_dollars",
        )

    @cached_property
    def account_risk(self) -> DataFrame:
        """The account risk table."""
        d = self.account_util_gap
        i, idle, gap, failed = (
            F.col("interactive_risk_dollars"),
            F.col("idle_revenue"),
            F.col("at_risk_dollars_bu1_revised"),
            F.col("failed_workload_risk_dollars"),
        )
        return d.select(
            "*",
            rules.total_risk(i, idle, gap, failed).alias("risk_dollars"),
            rules.adjusted_usage(F.col("interactive_usage_dollar_adjusted_100pct"), idle, gap, failed).alias(
                "usage_dollar_adjusted_100pct"
            ),
        )

    # -- entry C: newer run, cluster and warehouse metrics -----------------------------------
    @cached_property
    def run_costs(self) -> DataFrame:
        """Cost rows of runs ⋈ scoped runs on the five run keys."""
        c = self.costs.where(F.col("run_id").isNotNull())
        r = self.runs_scoped
        j = c.join(r, RUN_KEYS, "inner")
        rest_c = [x for x in c.columns if x not in RUN_KEYS]
        rest_r = [x for x in r.columns if x not in RUN_KEYS]
        return j.select(*RUN_KEYS, *rest_c, *rest_r)

    @cached_property
    def run_metrics(self) -> DataFrame:
        """Profile, utilization (E12-E18), interactive (E10-E11) and failure
        (E2-E4) columns on one frame: n cost rows of a run give n rows (X21).

        Runs are profiled once, then met by their cost rows; both sides are
        distinct, so the joined rows are the distinct rows of ``run_costs``.
        """
        runs = self.runs_scoped.distinct()
        prof = intervals.run_profile(runs, self.timeline_scoped, self.p)
        c = self.costs.where(F.col("run_id").isNotNull()).distinct()
        rest = [x for x in c.columns if x not in RUN_KEYS]
        prof = c.join(prof, RUN_KEYS, "inner").select(
            *RUN_KEYS, *rest, *[x for x in prof.columns if x not in RUN_KEYS]
        )
        df = add_utilization_risk(add_utilization(prof), self.p, self.p.average_utilization_penalty)
        rev, status = F.col("attributed_revenue"), F.col("workload_status")
        df = df.withColumn(
            "all_purpose_penalty",
            rules.flat_penalty(F.col("product_type"), self.p, self.p.null_product_penalty),
        )
        return df.withColumns(
            {
                "rev_risk_interactive_jobs": rules.interactive_risk(F.col("all_purpose_penalty"), rev),
                "job_status": rules.job_status(status, self.p),
                "failed_revenue_half": rules.failed_revenue_half(status, rev, self.p),
                "revenue_after_failures": rules.revenue_after_failures(status, rev, self.p),
            }
        )

    @cached_property
    def run_risk_combined(self) -> DataFrame:
        """D18 + E21: literal product-form risk and the E20 form side by side."""
        d = self.run_metrics
        rev = F.col("attributed_revenue")
        return d.withColumns(
            {
                "rev_at_risk_product": rules.revenue_at_risk_product(
                    rev,
                    F.col("rev_risk_interactive_jobs"),
                    F.col("rev_at_risk_utilization"),
                    F.col("revenue_after_failures"),
                ),
                "rev_at_risk": rules.revenue_at_risk(
                    rev, F.col("all_purpose_penalty"), F.col("utilization_penalty")
                ),
            }
        )

    @cached_property
    def interactive_penalty(self) -> DataFrame:
        """E10-E11 per cost row of a run."""
        c = self.costs.where(F.col("run_id").isNotNull()).select(
            *RUN_KEYS, "product_type", "attributed_revenue"
        )
        c = c.withColumn(
            "all_purpose_penalty",
            rules.flat_penalty(F.col("product_type"), self.p, self.p.null_product_penalty),
        )
        return c.withColumn(
            "rev_risk_interactive_jobs",
            rules.interactive_risk(F.col("all_purpose_penalty"), F.col("attributed_revenue")),
        )

    @cached_property
    def idle_revenue(self) -> DataFrame:
        """E5 per cost row (not aggregated)."""
        c = self.costs
        if self.p.scope_cluster_metrics:
            c = scope.semi(c, self.scope, ["workspace_id"])
        return c.select(
            "date",
            "workspace_id",
            "cluster_id",
            rules.idle_revenue(
                F.col("product_type"), F.col("sku"), F.col("workload_name"), F.col("attributed_revenue")
            ).alias("idle_revenue"),
        )

    @cached_property
    def config_periods(self) -> DataFrame:
        """W1/W2 over the wide configuration history."""
        cfg = self.configs
        if self.p.scope_cluster_metrics:
            cfg = scope.configs_in_scope(cfg, self.scope)
        return intervals.config_periods(cfg)

    @cached_property
    def cluster_idle_with_config(self) -> DataFrame:
        """Idle revenue rows with the configuration in force that day."""
        return intervals.effective_join(self.idle_revenue, self.config_periods)

    @cached_property
    def warehouse_daily(self) -> DataFrame:
        """F12 over scoped warehouse samples."""
        return rollups.warehouse_daily(self.warehouse_scoped)

    # -- F1 ------------------------------------------------------------------------
    @cached_property
    def workload_usage_daily(self) -> DataFrame:
        return rollups.workload_usage_daily(self.workload_usage, self.mapping)

    # -- per-row rule views over the cost source (E1-E9) ------------------------------------
    @cached_property
    def status_normalized(self) -> DataFrame:
        """E1 next to its three inputs."""
        raw = A.since(self.src.workload_costs, "date", self.p.start_date)
        t, c, pl = (
            F.col("tags.run_terminal_state"),
            F.col("tags.command_status"),
            F.col("tags.pipeline_state"),
        )
        return raw.select(
            "date",
            "workload_id",
            t.alias("run_terminal_state"),
            c.alias("command_status"),
            pl.alias("pipeline_state"),
            rules.normalized_status(t, c, pl).alias("workload_status"),
        )

    @cached_property
    def status_flags(self) -> DataFrame:
        """E2 / B16."""
        s = F.col("workload_status")
        return self.costs.select("date", "workload_id", "workload_status", rules.job_status(s, self.p).alias("job_status"))

    @cached_property
    def failure_risk(self) -> DataFrame:
        """E3-E4."""
        s, rev = F.col("workload_status"), F.col("attributed_revenue")
        return self.costs.select(
            "date",
            "workload_id",
            "workload_status",
            rules.job_status(s, self.p).alias("job_status"),
            rules.failed_revenue_half(s, rev, self.p).alias("failed_revenue_half"),
            rules.revenue_after_failures(s, rev, self.p).alias("revenue_after_failures"),
        )

    @cached_property
    def cost_flags(self) -> DataFrame:
        """B15 / E9."""
        sku = F.col("sku")
        return self.costs.select(
            "date",
            "workload_id",
            "sku",
            rules.sql_compute(sku).alias("sql_compute"),
            rules.serverless_sql_compute(sku).alias("serverless_sql_compute"),
        )

    @cached_property
    def tiered_interactive_risk(self) -> DataFrame:
        """E6-E7."""
        prod, sku, name, rev = (
            F.col("product_type"),
            F.col("sku"),
            F.col("workload_name"),
            F.col("attributed_revenue"),
        )
        return self.costs.select(
            "date",
            "workload_id",
            "product_type",
            "sku",
            "workload_name",
            rules.tiered_interactive_risk(prod, sku, name, rev, self.p).alias("all_purpose_job_revenue"),
            rules.tiered_corrected_revenue(prod, sku, name, rev, self.p).alias(
                "corrected_all_purpose_job_revenue"
            ),
        )

"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the rules in SURVEY §2, not generated from the Spark plans: the
run profile here is one plain left join with the containment predicate and a
group-by on all run columns, the config periods use ``lead`` over the whole
history, and so on.  The test tables are projected to the logical sources
with the mapping of FIXTURES.md §2 (struct fields flat).  Decimal outputs are
cast to DOUBLE on both sides; timestamps are naive UTC on both sides.
"""

from __future__ import annotations

START = "DATE '2024-01-05'"
CHANGE = "DATE '2024-01-03'"
EXCLUDED_NAMES = "('customer#000000003', 'customer#000000005')"

# name -> (deps, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (deps, body)


# --- fixture projections (FIXTURES.md §2.1) ---------------------------------------
# events with their workspace and cluster
cte("f_events", """
SELECT event_id, user_id, event_type, ts, value, ws, ws%10+1000+(user_id//25)%3*100 AS cl
FROM (SELECT *, CASE WHEN user_id%4=3 THEN user_id+25 ELSE user_id%25 END AS ws FROM events)""")

cte("f_usage_records", """
SELECT cast(ts AS date) AS usage_date, ws%7 AS account_id, ws AS workspace_id,
       CASE WHEN event_id%13=0 THEN NULL ELSE cl END AS cluster_id,
       CASE WHEN event_id%2=0 THEN 'SKU_A' ELSE 'SKU_B' END AS sku_name,
       CASE WHEN event_id%4=0 THEN 'INTERACTIVE' ELSE 'JOBS' END AS billing_origin
FROM f_events WHERE event_type IN ('purchase','click')""", "f_events")

cte("f_cluster_configs", """
SELECT ws AS workspace_id, cl AS cluster_id, CASE WHEN event_id%9=0 THEN -5 ELSE ws%7 END AS account_id,
       cast(ts AS date) AS change_date, cast(ts AS timestamp) AS change_time,
       event_id%4*30 AS auto_termination_minutes,
       CAST(NULL AS VARCHAR) AS cluster_name, CAST(NULL AS VARCHAR) AS driver_node_type,
       CAST(NULL AS VARCHAR) AS worker_node_type, CAST(NULL AS VARCHAR) AS runtime_version,
       CAST(NULL AS VARCHAR) AS cluster_source, CAST(NULL AS TIMESTAMP) AS create_time,
       CAST(NULL AS TIMESTAMP) AS delete_time, event_id%8 AS worker_count,
       CAST(NULL AS BIGINT) AS min_autoscale_workers, CAST(NULL AS BIGINT) AS max_autoscale_workers
FROM f_events WHERE event_type='signup'""", "f_events")

cte("f_node_timeline", """
SELECT ws%7 AS account_id, ws AS workspace_id, cl AS cluster_id,
       event_id%3 AS instance_id,
       CASE WHEN event_id%50=49 THEN NULL ELSE event_type='view' END AS driver,
       cast(ts AS timestamp) AS start_time, cast(ts AS timestamp) + INTERVAL '60' SECOND AS end_time,
       CAST(event_id%60 AS DOUBLE) AS cpu_user_percent, CAST(event_id%20 AS DOUBLE) AS cpu_system_percent,
       CAST(event_id%7 AS DOUBLE) AS cpu_wait_percent, CAST(event_id*7%100 AS DOUBLE) AS mem_used_percent,
       CAST(event_id%3 AS DOUBLE) AS mem_swap_percent,
       event_id*1000003 AS network_received_bytes, event_id*500009 AS network_sent_bytes
FROM f_events WHERE event_type IN ('view','click')""", "f_events")

cte("f_job_runs", """
SELECT cast(ts AS date) AS date, ws AS workspace_id, cl AS cluster_id,
       event_id%40 AS job_id, event_id AS run_id,
       cast(floor(value*600) AS BIGINT) AS duration_seconds, cast(ts AS timestamp) AS termination_time,
       CASE event_id%7 WHEN 2 THEN 'FAILED' ELSE 'SUCCEEDED' END AS terminal_state,
       CASE WHEN event_id%2=0 THEN 'NEW' ELSE 'EXISTING' END AS cluster_type,
       'NOTEBOOK' AS task_type, 'CRON' AS trigger_type
FROM f_events WHERE event_type='purchase'""", "f_events")

cte("f_workload_costs", """
SELECT CASE WHEN event_id%37=0 THEN cast(ts AS date) + 1 ELSE cast(ts AS date) END AS date,
       CASE WHEN event_id%23=0 THEN NULL WHEN event_id%29=0 THEN cl+100 ELSE cl END AS cluster_id,
       event_id + line*1000000000 AS workload_id,
       CASE WHEN event_id%41=0 THEN ws+10 ELSE ws END AS workspace_id,
       CASE WHEN ws=24 THEN -1 WHEN event_id%6=0 THEN ws+500000 ELSE ws END AS crm_account_id,
       CASE WHEN event_type='purchase' THEN CASE WHEN event_id%31=0 THEN -1 ELSE event_id%40 END END AS job_id,
       CASE WHEN event_type='purchase' THEN CASE WHEN event_id%43=0 THEN event_id+40 ELSE event_id END END AS run_id,
       CASE event_id%7 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'SUCCEEDED' WHEN 2 THEN 'FAILED'
            WHEN 4 THEN 'TimedOut' WHEN 6 THEN 'CANCELLED' END AS run_terminal_state,
       CASE event_id%4 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'FINISHED' WHEN 3 THEN 'Skipped' END AS command_status,
       CASE WHEN event_id%3=0 THEN NULL ELSE 'COMPLETED' END AS pipeline_state,
       CASE WHEN event_type='purchase' THEN 'jobRuns' ELSE 'idleWorkloads' END AS workload_name,
       CASE WHEN n%19=0 THEN NULL ELSE CASE n%8 WHEN 0 THEN 'ENTERPRISE_ALL_PURPOSE_COMPUTE'
            WHEN 1 THEN 'STANDARD_ALL_PURPOSE_COMPUTE' WHEN 2 THEN 'PREMIUM_ALL_PURPOSE_COMPUTE'
            WHEN 3 THEN 'PREMIUM_ALL_PURPOSE_SERVERLESS_COMPUTE' WHEN 4 THEN 'PREMIUM_SQL_COMPUTE'
            WHEN 5 THEN 'ENTERPRISE_SERVERLESS_SQL_COMPUTE' WHEN 6 THEN 'PREMIUM_JOBS_COMPUTE'
            ELSE 'OTHER_ALL_PURPOSE_COMPUTE' END END AS sku,
       CASE WHEN n%17=0 THEN NULL WHEN n%8 IN (4,5) THEN 'SQL' WHEN n%8=6 THEN 'JOBS'
            ELSE 'ALL_PURPOSE' END AS product_type,
       cast(value AS DECIMAL(18,4)) AS attributed_revenue,
       cast(event_id%5 AS DOUBLE) AS driver_cost_units, cast(event_id%9 AS DOUBLE) AS worker_cost_units
FROM (SELECT *, event_id + line AS n FROM f_events, (VALUES (0), (1)) AS l(line)
      WHERE event_type IN ('purchase','error')
        AND (line=0 OR (event_type='purchase' AND event_id%3=0)))""", "f_events")

cte("f_warehouse_metrics", """
SELECT cast(ts AS date) AS date, CASE WHEN event_id%27<>0 THEN cast(ts AS timestamp) END AS ts,
       ws*2+event_id%2+2000 AS warehouse_id, ws AS workspace_id,
       CASE WHEN event_id%3=0 THEN 'PRO' ELSE 'CLASSIC' END AS warehouse_type,
       event_id%2=0 AS serverless, event_id%10 AS executors_total, event_id%6 AS executors_active,
       event_id%16 AS active_tasks, CAST(16 AS BIGINT) AS task_slots, event_id%4 AS pending_tasks,
       event_id%6=5 AS at_full_capacity
FROM f_events WHERE event_type IN ('view','click','signup')""", "f_events")

cte("f_account_mapping", """
SELECT cast(e.ts AS date) AS date, CASE WHEN e.event_id%11=0 THEN c_custkey+500000 ELSE c_custkey END AS crm_account_id,
       CASE WHEN e.event_id%10=0 THEN -5 ELSE c_custkey%7 END AS account_id,
       CASE WHEN e.event_id%12=5 THEN c_custkey+7 ELSE c_custkey END AS workspace_id, concat(c_name,'-ws') AS workspace_name, c_mktsegment AS industry,
       concat('BU', cast(r_regionkey AS VARCHAR)) AS bu, r_name AS region, r_name AS bu_1,
       n_name AS bu_2, CASE WHEN n_nationkey%5=4 THEN NULL ELSE n_name END AS bu_3,
       c_name AS account_name, concat('P-',c_name) AS platform_account_name,
       concat('owner-',cast(c_custkey%3 AS VARCHAR)) AS account_owner
FROM f_events e JOIN customer ON c_custkey=e.ws JOIN nation ON c_nationkey=n_nationkey
     JOIN region ON n_regionkey=r_regionkey""", "f_events")

cte("f_workspaces", """
SELECT c_custkey AS workspace_id, c_custkey AS customer_id, c_custkey%7 AS account_id,
       CASE WHEN c_custkey%8=7 THEN ' Internal ' ELSE ' External ' END AS workspace_type,
       CASE WHEN c_custkey%11=10 THEN NULL ELSE c_name END AS crm_account_name,
       CASE WHEN c_custkey%13=12 THEN NULL ELSE c_custkey END AS crm_account_id
FROM customer""")

cte("f_excluded_accounts", """
SELECT s_suppkey AS account_id FROM supplier WHERE s_acctbal<1500""")

cte("f_workload_cluster_usage", """
SELECT DATE '2024-01-01' + CAST(l_orderkey%30 AS INTEGER) AS date, l_returnflag AS sku,
       l_linestatus AS workload_type, l_suppkey%7 AS account_id, l_suppkey AS workspace_id,
       CASE WHEN l_linenumber=7 THEN NULL ELSE l_partkey%200 END AS cluster_id,
       CAST(CAST(l_quantity AS INTEGER)*1024 AS BIGINT) AS memory_per_node_mb,
       CAST(l_linenumber AS BIGINT) AS cpus_per_node,
       CAST(l_extendedprice AS DECIMAL(18,4)) AS cost_units
FROM lineitem""")

# --- source adapters (A) -----------------------------------------------------------
cte("usage", f"""
SELECT DISTINCT usage_date AS date, account_id, workspace_id, cluster_id, sku_name,
       billing_origin AS usage_origin
FROM f_usage_records WHERE usage_date >= {START} AND cluster_id IS NOT NULL""", "f_usage_records")

cte("configs_narrow", f"""
SELECT cluster_id, workspace_id, account_id, auto_termination_minutes, change_time
FROM f_cluster_configs WHERE change_date >= {CHANGE}""", "f_cluster_configs")

cte("configs", f"""
SELECT cluster_id, cluster_name, create_time, delete_time, driver_node_type, worker_node_type,
       worker_count, min_autoscale_workers, max_autoscale_workers, auto_termination_minutes,
       runtime_version, workspace_id, account_id, change_time, change_date, cluster_source
FROM f_cluster_configs WHERE change_date >= {START}""", "f_cluster_configs")

_PCT = ("cpu_user", "cpu_system", "cpu_wait", "mem_used", "mem_swap")


def _timeline_cols(prefix: str) -> str:
    pct = ", ".join(f"{m}_percent AS {prefix}{m}_pct" for m in _PCT)
    return (
        f"{pct}, CAST(network_received_bytes AS DECIMAL(38,0)) AS {prefix}network_received_bytes, "
        f"CAST(network_sent_bytes AS DECIMAL(38,0)) AS {prefix}network_sent_bytes"
    )


cte("timeline", f"""
SELECT cast(start_time AS date) AS date, account_id, workspace_id, cluster_id, start_time, end_time,
       {_timeline_cols('')}, driver
FROM f_node_timeline WHERE cast(start_time AS date) >= {START}""", "f_node_timeline")

cte("timeline_driver", f"""
SELECT cast(start_time AS date) AS date, account_id, workspace_id, cluster_id, start_time, end_time,
       {_timeline_cols('d_')}
FROM f_node_timeline WHERE cast(start_time AS date) >= {START} AND driver IS TRUE""", "f_node_timeline")

cte("timeline_worker", f"""
SELECT cast(start_time AS date) AS date, account_id, workspace_id, cluster_id, instance_id,
       start_time, end_time, {_timeline_cols('w_')}
FROM f_node_timeline WHERE cast(start_time AS date) >= {START} AND driver IS FALSE""", "f_node_timeline")

cte("job_runs", f"""
SELECT date, workspace_id, cluster_id, job_id, run_id,
       termination_time - to_seconds(duration_seconds) AS run_start_time,
       date_trunc('minute', termination_time - to_seconds(duration_seconds)) AS run_start_floor,
       date_trunc('minute', termination_time) + INTERVAL 1 MINUTE AS run_term_ceil,
       duration_seconds, termination_time, terminal_state, cluster_type, task_type, trigger_type
FROM f_job_runs WHERE date >= {START}""", "f_job_runs")

_STATUS = """CASE WHEN lower(run_terminal_state) = 'running' THEN lower(command_status)
            WHEN run_terminal_state IS NOT NULL THEN lower(run_terminal_state)
            WHEN command_status IS NOT NULL THEN lower(command_status)
            ELSE lower(pipeline_state) END"""

cte("costs", f"""
SELECT date, cluster_id, workload_id, workspace_id, crm_account_id, job_id, run_id, workload_name,
       sku, product_type, {_STATUS} AS workload_status, attributed_revenue,
       driver_cost_units, worker_cost_units
FROM f_workload_costs WHERE date >= {START}""", "f_workload_costs")

cte("warehouse", f"""
SELECT date, ts, warehouse_id, workspace_id, warehouse_type, serverless, executors_total,
       executors_active, active_tasks, task_slots, pending_tasks, at_full_capacity
FROM f_warehouse_metrics WHERE date > {START}""", "f_warehouse_metrics")

_MAP_COLS = """date, crm_account_id, account_id, workspace_id, workspace_name, industry, bu, region,
       bu_1, bu_2, bu_3, account_name, platform_account_name, account_owner"""

cte("mapping", f"""
SELECT DISTINCT {_MAP_COLS} FROM f_account_mapping WHERE date >= {START}""", "f_account_mapping")

_SCOPE_BASE = f"""
SELECT workspace_id, customer_id AS crm_account_id, account_id FROM f_workspaces
WHERE lower(trim(workspace_type)) = 'external'
  AND crm_account_name IS NOT NULL AND crm_account_id IS NOT NULL
  AND lower(trim(crm_account_name)) NOT IN {EXCLUDED_NAMES}
  AND customer_id IS NOT NULL"""

cte("scope", _SCOPE_BASE + """
  AND customer_id NOT IN (SELECT account_id FROM f_excluded_accounts WHERE account_id IS NOT NULL)""",
    "f_workspaces", "f_excluded_accounts")

cte("scope_not_in", _SCOPE_BASE + """
  AND customer_id NOT IN (SELECT DISTINCT account_id FROM f_excluded_accounts)""",
    "f_workspaces", "f_excluded_accounts")

# --- scope joins (D1-D4) ---------------------------------------------------------------
cte("runs_scoped", """
SELECT r.* FROM job_runs r WHERE EXISTS (SELECT 1 FROM scope s WHERE s.workspace_id = r.workspace_id)""",
    "job_runs", "scope")

cte("configs_scoped", """
SELECT c.* FROM configs_narrow c WHERE EXISTS (
  SELECT 1 FROM scope s WHERE s.workspace_id = c.workspace_id AND s.account_id = c.account_id)""",
    "configs_narrow", "scope")

cte("mapping_scoped", f"""
SELECT m.* FROM mapping m WHERE EXISTS (
  SELECT 1 FROM scope s WHERE s.workspace_id = m.workspace_id AND s.crm_account_id = m.crm_account_id
    AND s.account_id = m.account_id) AND m.date >= {START}""", "mapping", "scope")

_LINE_TEXT = ", ".join(
    f"coalesce({c.strip()}::VARCHAR, '<null>')" for c in _MAP_COLS.split(",") if c.strip() != "date")

# Days of a key with the same list of lines, one after the other, are one period.
cte("mapping_periods", f"""
SELECT m.* EXCLUDE (date), p.valid_from, p.valid_to FROM mapping m JOIN (
  SELECT workspace_id, crm_account_id, min(date) AS valid_from, max(date) AS valid_to
  FROM (SELECT *, sum(new) OVER (PARTITION BY workspace_id, crm_account_id ORDER BY date) AS period
        FROM (SELECT *, CASE WHEN lag(date) OVER w = date - 1 AND lag(state) OVER w = state THEN 0 ELSE 1 END AS new
              FROM (SELECT workspace_id, crm_account_id, date, list(d ORDER BY d) AS state
                    FROM (SELECT workspace_id, crm_account_id, date, concat_ws('|', {_LINE_TEXT}) AS d FROM mapping) GROUP BY ALL)
              WINDOW w AS (PARTITION BY workspace_id, crm_account_id ORDER BY date)))
  GROUP BY workspace_id, crm_account_id, period) p
ON m.workspace_id IS NOT DISTINCT FROM p.workspace_id AND m.crm_account_id IS NOT DISTINCT FROM p.crm_account_id
   AND m.date = p.valid_from""", "mapping")

cte("warehouse_scoped", """
SELECT w.* FROM warehouse w WHERE EXISTS (SELECT 1 FROM scope s WHERE s.workspace_id = w.workspace_id)""",
    "warehouse", "scope")

# --- entry A ---------------------------------------------------------------------
cte("runs_with_usage", """
SELECT r.*, u.usage_origin, u.sku_name
FROM runs_scoped r LEFT JOIN (SELECT DISTINCT date, workspace_id, cluster_id, usage_origin, sku_name FROM usage) u
  ON r.date = u.date AND r.workspace_id = u.workspace_id AND r.cluster_id = u.cluster_id""",
    "runs_scoped", "usage")

cte("runs_with_config", """
SELECT r.*, c.auto_termination_minutes
FROM runs_with_usage r LEFT JOIN (
  SELECT DISTINCT workspace_id, cluster_id, auto_termination_minutes FROM configs_scoped) c
  ON r.workspace_id = c.workspace_id AND r.cluster_id = c.cluster_id""",
    "runs_with_usage", "configs_scoped")

cte("run_base", "SELECT DISTINCT * FROM runs_with_config", "runs_with_config")


_GRID = 2**60


def _mean(x: str) -> str:
    """The average of doubles that are not negative, summed exactly as HUGEINTs in steps of
    2^-60, so that it does not depend on the order of rows."""
    steps = (f"CAST(floor({x}) AS HUGEINT) * {_GRID}"
             f" + CAST(CAST(({x} - floor({x})) * {_GRID}.0::DOUBLE AS BIGINT) AS HUGEINT)")
    return (f"(CAST(sum({steps}) // {_GRID} AS DOUBLE)"
            f" + CAST(sum({steps}) % {_GRID} AS DOUBLE) / {_GRID}.0::DOUBLE) / count({x})")


def _role_aggs(role_test: str, prefix: str) -> str:
    parts = []
    for m in _PCT:
        v = f"CASE WHEN {role_test} THEN t.{m}_pct END"
        parts += [
            f"min({v}) AS min_{prefix}{m}_pct",
            f"{_mean(v)} AS avg_{prefix}{m}_pct",
            f"max({v}) AS max_{prefix}{m}_pct",
        ]
    for b in ("network_received_bytes", "network_sent_bytes"):
        parts.append(f"sum(CASE WHEN {role_test} THEN t.{b} END) AS sum_{prefix}{b}")
    return ",\n       ".join(parts)


_CONTAINED = """t.date = r.date AND t.workspace_id = r.workspace_id AND t.cluster_id = r.cluster_id
  AND t.start_time >= r.run_start_floor AND t.end_time <= r.run_term_ceil"""


def _profile(src: str, roles: str, contained: str = _CONTAINED) -> str:
    aggs = []
    if "d" in roles:
        aggs.append(_role_aggs("t.driver IS TRUE", "d_"))
    if "w" in roles:
        aggs.append(_role_aggs("t.driver IS FALSE", "w_"))
    return (
        f"SELECT r.*, {', '.join(aggs)}\nFROM {src} r LEFT JOIN timeline t ON {contained}\n"
        "GROUP BY ALL"
    )


cte("run_driver_profile", _profile("run_base", "d"), "run_base", "timeline")
cte("run_worker_profile", _profile("run_base", "dw"), "run_base", "timeline")
# X15 off: samples of any date count
cte("run_worker_profile_any_date", _profile("run_base", "dw", _CONTAINED.replace("t.date = r.date AND ", "")),
    "run_base", "timeline")

_COST_COLS = """c.workload_id, c.workload_name, c.sku, c.product_type, c.workload_status,
       c.attributed_revenue, c.driver_cost_units, c.worker_cost_units"""
_MAP_DIMS = """m.crm_account_id, m.account_id, m.workspace_name, m.industry, m.bu, m.region, m.bu_1,
       m.bu_2, m.bu_3, m.account_name, m.platform_account_name, m.account_owner"""

def _costs_mapped(src: str) -> str:
    return f"""
SELECT u.*, {_COST_COLS}, {_MAP_DIMS}
FROM {src} u
JOIN costs c ON u.date = c.date AND u.workspace_id = c.workspace_id AND u.cluster_id = c.cluster_id
  AND u.job_id = c.job_id AND u.run_id = c.run_id
JOIN mapping_scoped m ON c.date = m.date AND c.workspace_id = m.workspace_id
  AND c.crm_account_id = m.crm_account_id
WHERE u.date >= {START} AND c.job_id IS NOT NULL AND c.run_id IS NOT NULL"""


cte("run_costs_mapped", _costs_mapped("run_worker_profile"),
    "run_worker_profile", "costs", "mapping_scoped")

_DSHARE = "driver_cost_units / NULLIF(driver_cost_units + worker_cost_units, 0)"
_WSHARE = "worker_cost_units / NULLIF(worker_cost_units + driver_cost_units, 0)"


def _derived(src: str) -> str:
    wcpu = "(avg_w_cpu_user_pct + avg_w_cpu_system_pct)"
    dcpu = "(avg_d_cpu_user_pct + avg_d_cpu_system_pct)"
    return f"""
SELECT *, {wcpu} AS avg_worker_cpu_utilization, {dcpu} AS avg_driver_cpu_utilization,
       {_DSHARE} AS driver_cost_share, {_WSHARE} AS worker_cost_share,
       {wcpu} * ({_WSHARE}) AS worker_weighted_cpu_utilization,
       {dcpu} * ({_DSHARE}) AS driver_weighted_cpu_utilization,
       {wcpu} * ({_WSHARE}) + {dcpu} * ({_DSHARE}) AS avg_cluster_cpu_utilization,
       avg_w_mem_used_pct * ({_WSHARE}) + avg_d_mem_used_pct * ({_DSHARE}) AS avg_cluster_mem_used_percent,
       avg_w_mem_swap_pct * ({_WSHARE}) + avg_d_mem_swap_pct * ({_DSHARE}) AS avg_mem_swap_used_percent,
       avg_w_cpu_wait_pct * ({_WSHARE}) + avg_d_cpu_wait_pct * ({_DSHARE}) AS avg_cpu_wait_percent,
       CAST(sum_d_network_received_bytes + sum_w_network_received_bytes AS DOUBLE) / 1e9 AS total_network_gb_received,
       CAST(sum_d_network_sent_bytes + sum_w_network_sent_bytes AS DOUBLE) / 1e9 AS total_network_gb_sent,
       ({wcpu} IS NOT NULL AND {dcpu} IS NOT NULL) AS has_full_profile
FROM {src}"""


_UPEN = """(greatest(30 - avg_cluster_cpu_utilization, 0) / 30
        + greatest(50 - avg_cluster_mem_used_percent, 0) / 50) / 2"""


def _util_risk(src: str) -> str:
    return f"""
SELECT *, {_UPEN} AS utilization_penalty,
       attributed_revenue * ({_UPEN}) AS rev_at_risk_utilization
FROM {src}"""


_FLAT = "CASE WHEN product_type <> 'JOBS' THEN CAST(0.6 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"

_FLAT_NULL = """CASE WHEN product_type = 'JOBS' THEN CAST(0.0 AS DOUBLE)
        WHEN product_type <> 'JOBS' THEN CAST(0.6 AS DOUBLE) END"""


def _run_risk(src: str, flat: str = _FLAT) -> str:
    return f"""
SELECT *, {flat} AS all_purpose_penalty,
       ({flat}) * (attributed_revenue - attributed_revenue * utilization_penalty) AS rev_at_risk_all_purpose,
       attributed_revenue * (({flat}) + utilization_penalty - ({flat}) * utilization_penalty) AS rev_at_risk
FROM {src}"""


cte("run_utilization_derived", _derived("run_costs_mapped"), "run_costs_mapped")
cte("run_utilization_risk", _util_risk("run_utilization_derived"), "run_utilization_derived")
cte("run_risk", _run_risk("run_utilization_risk"), "run_utilization_risk")
# options: E10b (null product, null penalty), E17b (sum of the shortfalls)
cte("run_risk_null_product", _run_risk("run_utilization_risk", _FLAT_NULL), "run_utilization_risk")
_UPEN_SUM = _UPEN.removesuffix(" / 2")
cte("run_utilization_risk_sum", f"""
SELECT *, {_UPEN_SUM} AS utilization_penalty,
       attributed_revenue * ({_UPEN_SUM}) AS rev_at_risk_utilization
FROM run_utilization_derived""", "run_utilization_derived")
# Each cost line once, so runs are not fanned out by usage and settings
cte("run_lines", "SELECT DISTINCT * FROM runs_scoped", "runs_scoped")
cte("run_lines_profile", _profile("run_lines", "dw"), "run_lines", "timeline")
cte("run_lines_mapped", _costs_mapped("run_lines_profile"), "run_lines_profile", "costs", "mapping_scoped")
cte("run_lines_derived", _derived("run_lines_mapped"), "run_lines_mapped")
cte("run_lines_risk", _run_risk("(" + _util_risk("run_lines_derived") + ")"), "run_lines_derived")

_ROLLUP_AGGS = f"""CAST(sum(duration_seconds) AS BIGINT) AS total_duration_seconds,
       {_mean('avg_cluster_cpu_utilization')} AS avg_cluster_cpu_utilization,
       {_mean('avg_cluster_mem_used_percent')} AS avg_cluster_mem_used_percent,
       {_mean('total_network_gb_sent')} AS avg_cluster_network_gb_sent,
       {_mean('total_network_gb_received')} AS avg_cluster_network_gb_received,
       count(DISTINCT run_id) AS job_run_count,
       sum(attributed_revenue) AS revenue,
       sum(CAST(rev_at_risk AS DECIMAL(28,10))) AS total_revenue_at_risk,
       sum(CAST(rev_at_risk_utilization AS DECIMAL(28,10))) AS revenue_at_risk_utilization,
       sum(CAST(rev_at_risk_all_purpose AS DECIMAL(28,10))) AS revenue_at_risk_all_purpose_jobs"""


def _rollup(keys: str, src: str = "run_risk") -> str:
    return f"SELECT {keys}, {_ROLLUP_AGGS}\nFROM {src} GROUP BY {keys}"


cte("risk_rollup_account", _rollup("account_id, account_name, bu, region, bu_1, bu_2, bu_3, date"), "run_risk")
cte("risk_rollup_workspace", _rollup(
    "account_id, account_name, workspace_name, bu, region, bu_1, bu_2, bu_3, date, workspace_id"), "run_risk")
cte("risk_rollup_job", _rollup(
    "account_id, account_name, workspace_name, workspace_id, bu, region, bu_1, bu_2, bu_3, date, job_id"),
    "run_risk")

_JOB_KEYS = "account_id, account_name, workspace_name, workspace_id, bu, region, bu_1, bu_2, bu_3, date, job_id"
_LEVELS = {"account": ("workspace_name", "workspace_id", "job_id"), "workspace": ("job_id",), "job": ()}


def _level(name: str, finer: tuple[str, ...]) -> str:
    keys = ", ".join(f"NULL AS {k}" if k in finer else k for k in _JOB_KEYS.split(", "))
    group = ", ".join(k for k in _JOB_KEYS.split(", ") if k not in finer)
    return f"SELECT '{name}' AS level, {keys}, {_ROLLUP_AGGS}\nFROM run_risk GROUP BY {group}"


cte("risk_rollup_levels", "\nUNION ALL\n".join(_level(n, f) for n, f in _LEVELS.items()), "run_risk")

cte("run_line_copies", """
SELECT date, workspace_id, cluster_id, job_id, run_id, count(*) AS copies
FROM (SELECT r.*, u.usage_origin, u.sku_name, c.auto_termination_minutes
      FROM (SELECT DISTINCT * FROM runs_scoped) r
      LEFT JOIN (SELECT DISTINCT date, workspace_id, cluster_id, usage_origin, sku_name FROM usage) u
        USING (date, workspace_id, cluster_id)
      LEFT JOIN (SELECT DISTINCT workspace_id, cluster_id, auto_termination_minutes FROM configs_scoped) c
        USING (workspace_id, cluster_id))
GROUP BY ALL""", "runs_scoped", "usage", "configs_scoped")

cte("risk_rollup_account_lines", _rollup(
    "account_id, account_name, bu, region, bu_1, bu_2, bu_3, date", "run_lines_risk"), "run_lines_risk")

# --- entry B -----------------------------------------------------------------------
# Failure statuses and SKU names, as in costlens/params.py.
_FAILED = "coalesce(workload_status IN ('cancelled','error','failed','skipped','timedout','canceled'), false)"
_AP = "product_type = 'ALL_PURPOSE' AND NOT (sku ILIKE '%serverl%')"
_ENT = ("'ENTERPRISE_ALL_PURPOSE_COMPUTE', 'ENTERPRISE_ALL_PURPOSE_COMPUTE_(PHOTON)', "
        "'ENTERPRISE_ALL_PURPOSE_COMPUTE_GOV', 'ENTERPRISE_ALL_PURPOSE_COMPUTE_(PHOTON)_GOV'")
_STD = "'STANDARD_ALL_PURPOSE_COMPUTE', 'STANDARD_ALL_PURPOSE_COMPUTE_(PHOTON)'"
_PRE = "'PREMIUM_ALL_PURPOSE_COMPUTE', 'PREMIUM_ALL_PURPOSE_COMPUTE_(PHOTON)'"


def _tier(f_ent: str, f_std: str, f_pre: str, other: str) -> str:
    return (
        f"CASE WHEN sku IN ({_ENT}) THEN round(attributed_revenue * {f_ent}, 2) "
        f"WHEN sku IN ({_STD}) THEN round(attributed_revenue * {f_std}, 2) "
        f"WHEN sku IN ({_PRE}) THEN round(attributed_revenue * {f_pre}, 2) ELSE {other} END"
    )


_IDLE = f"CASE WHEN {_AP} AND workload_name = 'idleWorkloads' THEN round(attributed_revenue, 2) ELSE 0 END"
_TIER_RISK = f"CASE WHEN {_AP} AND workload_name = 'jobRuns' THEN {_tier('0.700', '0.625', '0.455', '0')} ELSE 0 END"
_TIER_CORR = (f"CASE WHEN {_AP} AND workload_name = 'jobRuns' THEN "
              f"{_tier('0.300', '0.375', '0.545', 'round(attributed_revenue, 2)')} "
              "ELSE round(attributed_revenue, 2) END")
_JOB_STATUS = f"CASE WHEN {_FAILED} THEN 'failed' ELSE 'success' END"
_FAIL_HALF = f"CASE WHEN {_FAILED} THEN round(attributed_revenue * 0.5, 2) ELSE 0 END"
_AFTER_FAIL = f"CASE WHEN {_FAILED} THEN round(attributed_revenue * 0.5, 2) ELSE round(attributed_revenue, 2) END"

_DIMS = ("date, industry, bu, region, bu_1, bu_2, bu_3, account_name, platform_account_name, "
         "workspace_name, account_owner")
_DIMS_NODATE = _DIMS.replace("date, ", "", 1)

cte("account_cost_core", f"""
SELECT date, workspace_id, crm_account_id, {_DIMS_NODATE},
       {_IDLE} AS idle_revenue, {_TIER_RISK} AS all_purpose_job_revenue,
       {_TIER_CORR} AS corrected_all_purpose_job_revenue,
       round(attributed_revenue, 2) AS rounded_revenue,
       sku ILIKE '%SQL%' AS sql_compute,
       (sku ILIKE '%SQL%' AND sku ILIKE '%SERVERLESS%') AS serverless_sql_compute,
       {_JOB_STATUS} AS job_status, {_FAIL_HALF} AS failed_revenue_half,
       {_AFTER_FAIL} AS revenue_after_failures
FROM costs c JOIN mapping m USING (date, workspace_id, crm_account_id)
WHERE date >= {START}""", "costs", "mapping")

cte("account_cost_totals", f"""
SELECT {_DIMS}, sum(idle_revenue) AS idle_revenue,
       sum(all_purpose_job_revenue) AS interactive_risk_dollars,
       sum(corrected_all_purpose_job_revenue) AS interactive_usage_dollar_adjusted_100pct,
       sum(rounded_revenue) AS usage_amount,
       sum(failed_revenue_half) AS failed_workload_risk_dollars,
       sum(revenue_after_failures) AS failed_workload_usage_dollar_adjusted_50pct
FROM account_cost_core GROUP BY {_DIMS}""", "account_cost_core")

cte("warehouse_tasks_daily", """
SELECT date, workspace_id, serverless, CAST(sum(active_tasks) AS BIGINT) AS active_tasks,
       CAST(sum(task_slots) AS BIGINT) AS task_slots
FROM warehouse GROUP BY date, workspace_id, serverless""", "warehouse")

cte("sql_rows", """
SELECT c.*, h.active_tasks, h.task_slots
FROM account_cost_core c LEFT JOIN warehouse_tasks_daily h
  ON c.date = h.date AND c.workspace_id = h.workspace_id AND c.serverless_sql_compute = h.serverless
WHERE c.sql_compute = true""", "account_cost_core", "warehouse_tasks_daily")

cte("warehouse_util_by_unit", """
SELECT date, bu_1, CAST(sum(active_tasks) AS BIGINT) AS dat_bu1, CAST(sum(task_slots) AS BIGINT) AS dts_bu1
FROM sql_rows GROUP BY date, bu_1""", "sql_rows")

cte("warehouse_util_by_account", f"""
SELECT {_DIMS}, u.dat_bu1, u.dts_bu1, CAST(sum(s.active_tasks) AS BIGINT) AS dat_acnt,
       CAST(sum(s.task_slots) AS BIGINT) AS dts_acnt, sum(s.rounded_revenue) AS sql_dollars
FROM sql_rows s LEFT JOIN warehouse_util_by_unit u USING (date, bu_1)
GROUP BY {_DIMS}, u.dat_bu1, u.dts_bu1""", "sql_rows", "warehouse_util_by_unit")

# X5 "none": a day's warehouse totals once per (dims, workspace, serverless)
cte("sql_units", f"""
SELECT {_DIMS}, workspace_id, serverless_sql_compute, sum(rounded_revenue) AS rounded_revenue
FROM account_cost_core WHERE sql_compute = true
GROUP BY {_DIMS}, workspace_id, serverless_sql_compute""", "account_cost_core")
cte("sql_unit_rows", """
SELECT c.*, h.active_tasks, h.task_slots
FROM sql_units c LEFT JOIN warehouse_tasks_daily h
  ON c.date = h.date AND c.workspace_id = h.workspace_id AND c.serverless_sql_compute = h.serverless""",
    "sql_units", "warehouse_tasks_daily")
cte("warehouse_util_by_account_once", f"""
SELECT {_DIMS}, u.dat_bu1, u.dts_bu1, CAST(sum(s.active_tasks) AS BIGINT) AS dat_acnt,
       CAST(sum(s.task_slots) AS BIGINT) AS dts_acnt, sum(s.rounded_revenue) AS sql_dollars
FROM sql_unit_rows s LEFT JOIN (
  SELECT date, bu_1, CAST(sum(active_tasks) AS BIGINT) AS dat_bu1, CAST(sum(task_slots) AS BIGINT) AS dts_bu1
  FROM sql_unit_rows GROUP BY date, bu_1) u USING (date, bu_1)
GROUP BY {_DIMS}, u.dat_bu1, u.dts_bu1""", "sql_unit_rows")

_DIM_JOIN = " AND ".join(f"t.{d} = a.{d}" for d in _DIMS.split(", "))
cte("account_cost_and_util", f"""
SELECT {', '.join('t.' + d for d in _DIMS.split(', '))},
       sum(t.idle_revenue) AS idle_revenue, sum(t.interactive_risk_dollars) AS interactive_risk_dollars,
       sum(t.interactive_usage_dollar_adjusted_100pct) AS interactive_usage_dollar_adjusted_100pct,
       sum(t.usage_amount) AS usage_amount, CAST(sum(a.dat_bu1) AS BIGINT) AS dat_bu1,
       CAST(sum(a.dts_bu1) AS BIGINT) AS dts_bu1, CAST(sum(a.dat_acnt) AS BIGINT) AS dat_acnt,
       CAST(sum(a.dts_acnt) AS BIGINT) AS dts_acnt, sum(a.sql_dollars) AS sql_dollars,
       sum(t.failed_workload_risk_dollars) AS failed_workload_risk_dollars
FROM account_cost_totals t LEFT JOIN warehouse_util_by_account a ON {_DIM_JOIN}
GROUP BY {', '.join('t.' + d for d in _DIMS.split(', '))}""",
    "account_cost_totals", "warehouse_util_by_account")

_TAIL = """usage_amount, idle_revenue, interactive_risk_dollars, interactive_usage_dollar_adjusted_100pct,
       failed_workload_risk_dollars"""

cte("account_util_ratios", f"""
SELECT {_DIMS}, dat_bu1 / NULLIF(dts_bu1, 0) AS overall_avg_utilization_bu1,
       dat_acnt / NULLIF(dts_acnt, 0) AS overall_avg_utilization_acnt, sql_dollars, {_TAIL}
FROM account_cost_and_util""", "account_cost_and_util")

_U, _A = "overall_avg_utilization_bu1", "overall_avg_utilization_acnt"
_GAP = f"coalesce(({_U} - {_A}) / NULLIF({_U}, 0), 0.0)"
cte("account_util_gap", f"""
SELECT {_DIMS}, {_U}, {_A}, sql_dollars,
       CASE WHEN {_U} >= {_A} THEN {_GAP} ELSE 0.0 END AS risk_pct_bu1,
       CASE WHEN {_U} >= {_A} THEN {_GAP} * sql_dollars ELSE 0.0 END AS at_risk_dollars_bu1,
       CASE WHEN {_U} >= {_A} THEN (sql_dollars * {_U}) * {_GAP} ELSE 0.0 END AS at_risk_dollars_bu1_revised,
       {_TAIL}
FROM account_util_ratios""", "account_util_ratios")

cte("account_risk", """
SELECT *, interactive_risk_dollars + idle_revenue + at_risk_dollars_bu1_revised + failed_workload_risk_dollars
          AS risk_dollars,
       interactive_usage_dollar_adjusted_100pct
         - (idle_revenue + at_risk_dollars_bu1_revised + failed_workload_risk_dollars) AS usage_dollar_adjusted_100pct
FROM account_util_gap""", "account_util_gap")

# --- entry C -----------------------------------------------------------------------
cte("run_costs", """
SELECT c.date, c.workspace_id, c.cluster_id, c.job_id, c.run_id, c.workload_id, c.crm_account_id,
       c.workload_name, c.sku, c.product_type, c.workload_status, c.attributed_revenue,
       c.driver_cost_units, c.worker_cost_units,
       r.run_start_time, r.run_start_floor, r.run_term_ceil, r.duration_seconds, r.termination_time,
       r.terminal_state, r.cluster_type, r.task_type, r.trigger_type
FROM costs c JOIN runs_scoped r ON c.date = r.date AND c.workspace_id = r.workspace_id
  AND c.cluster_id = r.cluster_id AND c.job_id = r.job_id AND c.run_id = r.run_id
WHERE c.run_id IS NOT NULL""", "costs", "runs_scoped")

cte("run_costs_profile", _profile("(SELECT DISTINCT * FROM run_costs)", "dw"), "run_costs", "timeline")
cte("run_costs_derived", _derived("run_costs_profile"), "run_costs_profile")
cte("run_metrics", f"""
SELECT *, {_FLAT} AS all_purpose_penalty,
       ({_FLAT}) * attributed_revenue AS rev_risk_interactive_jobs,
       {_JOB_STATUS} AS job_status, {_FAIL_HALF} AS failed_revenue_half,
       {_AFTER_FAIL} AS revenue_after_failures
FROM ({_util_risk('run_costs_derived')})""", "run_costs_derived")

cte("run_risk_combined", """
SELECT *, attributed_revenue * (rev_risk_interactive_jobs + rev_at_risk_utilization + revenue_after_failures)
          AS rev_at_risk_product,
       attributed_revenue * (all_purpose_penalty + utilization_penalty - all_purpose_penalty * utilization_penalty)
          AS rev_at_risk
FROM run_metrics""", "run_metrics")

cte("interactive_penalty", f"""
SELECT date, workspace_id, cluster_id, job_id, run_id, product_type, attributed_revenue,
       {_FLAT} AS all_purpose_penalty, ({_FLAT}) * attributed_revenue AS rev_risk_interactive_jobs
FROM costs WHERE run_id IS NOT NULL""", "costs")

cte("idle_revenue", f"""
SELECT date, workspace_id, cluster_id, {_IDLE} AS idle_revenue FROM costs""", "costs")

_TIES = ("auto_termination_minutes, worker_count, min_autoscale_workers, max_autoscale_workers, "
         "cluster_name, driver_node_type, worker_node_type, runtime_version, cluster_source, "
         "create_time, delete_time, account_id")
_TIE_ORDER = ", ".join(f"{c} NULLS FIRST" for c in _TIES.split(", "))
cte("config_periods", f"""
SELECT *, lead(change_date) OVER (PARTITION BY workspace_id, cluster_id
                                  ORDER BY change_date, change_time NULLS FIRST, {_TIE_ORDER}) - 1 AS valid_to
FROM (SELECT DISTINCT * FROM configs)""", "configs")

cte("cluster_idle_with_config", """
SELECT i.date, i.workspace_id, i.cluster_id, i.idle_revenue,
       p.cluster_name, p.create_time, p.delete_time, p.driver_node_type, p.worker_node_type,
       p.worker_count, p.min_autoscale_workers, p.max_autoscale_workers, p.auto_termination_minutes,
       p.runtime_version, p.account_id, p.change_time, p.change_date, p.cluster_source, p.valid_to
FROM idle_revenue i LEFT JOIN config_periods p
  ON i.workspace_id = p.workspace_id AND i.cluster_id = p.cluster_id AND i.date >= p.change_date
 AND (i.date <= p.valid_to OR p.valid_to IS NULL)""", "idle_revenue", "config_periods")

def _idle_with_config(idle: str, periods: str) -> str:
    return CTES["cluster_idle_with_config"][1].replace("FROM idle_revenue", f"FROM {idle}").replace(
        "JOIN config_periods", f"JOIN {periods}")


# X11 scoped: both inputs of the idle table limited to the scope
cte("idle_revenue_in_scope", """
SELECT i.* FROM idle_revenue i WHERE EXISTS (SELECT 1 FROM scope s WHERE s.workspace_id = i.workspace_id)""",
    "idle_revenue", "scope")
cte("config_periods_in_scope", CTES["config_periods"][1].replace("FROM configs)", """FROM configs c WHERE EXISTS (
  SELECT 1 FROM scope s WHERE s.workspace_id = c.workspace_id AND s.account_id = c.account_id))"""),
    "configs", "scope")
cte("cluster_idle_with_config_scoped",
    _idle_with_config("idle_revenue_in_scope", "config_periods_in_scope"),
    "idle_revenue_in_scope", "config_periods_in_scope")

cte("warehouse_daily", """
SELECT date, warehouse_id, workspace_id,
       first(warehouse_type ORDER BY ts, warehouse_type NULLS FIRST) FILTER (WHERE ts IS NOT NULL)
         AS warehouse_type,
       first(serverless ORDER BY ts, serverless NULLS FIRST) FILTER (WHERE ts IS NOT NULL) AS serverless,
       CAST(sum(active_tasks) AS BIGINT) AS active_tasks, CAST(sum(task_slots) AS BIGINT) AS task_slots,
       avg(executors_total) AS avg_executors_total, avg(executors_active) AS avg_executors_active,
       avg(pending_tasks) AS avg_pending_tasks
FROM warehouse_scoped GROUP BY date, warehouse_id, workspace_id""", "warehouse_scoped")

cte("workload_usage", f"SELECT * FROM f_workload_cluster_usage WHERE date >= {START}",
    "f_workload_cluster_usage")

cte("workload_usage_daily", """
SELECT a.*, d.bu, d.bu_1, d.bu_2, d.bu_3, d.workspace_name, d.account_name
FROM (SELECT date, sku, workload_type, workspace_id, count(cluster_id) AS cluster_id_count,
             avg(memory_per_node_mb) AS avg_memory_per_node_mb, avg(cpus_per_node) AS avg_num_cpus_per_node,
             sum(cost_units) AS sum_cost_units
      FROM workload_usage GROUP BY date, sku, workload_type, workspace_id) a
LEFT JOIN (SELECT DISTINCT workspace_id, bu, bu_1, bu_2, bu_3, workspace_name, account_name FROM mapping) d
  ON a.workspace_id = d.workspace_id""", "workload_usage", "mapping")

# --- per-row rule views over the cost source -----------------------------------------
cte("costs_sql", "SELECT * FROM costs WHERE job_id IS NOT NULL AND run_id IS NOT NULL", "costs")
cte("costs_with_run", "SELECT * FROM costs WHERE job_id IS NOT NULL AND run_id IS NOT NULL", "costs")
cte("status_normalized", f"""
SELECT date, workload_id, run_terminal_state, command_status, pipeline_state, {_STATUS} AS workload_status
FROM f_workload_costs WHERE date >= {START}""", "f_workload_costs")
cte("status_flags", f"SELECT date, workload_id, workload_status, {_JOB_STATUS} AS job_status FROM costs",
    "costs")
cte("failure_risk", f"""
SELECT date, workload_id, workload_status, {_JOB_STATUS} AS job_status,
       {_FAIL_HALF} AS failed_revenue_half, {_AFTER_FAIL} AS revenue_after_failures
FROM costs""", "costs")
cte("cost_flags", """
SELECT date, workload_id, sku, sku ILIKE '%SQL%' AS sql_compute,
       (sku ILIKE '%SQL%' AND sku ILIKE '%SERVERLESS%') AS serverless_sql_compute
FROM costs""", "costs")
cte("tiered_interactive_risk", f"""
SELECT date, workload_id, product_type, sku, workload_name, {_TIER_RISK} AS all_purpose_job_revenue,
       {_TIER_CORR} AS corrected_all_purpose_job_revenue
FROM costs""", "costs")


def _order(name: str, seen: list[str]) -> None:
    if name in seen:
        return
    deps, _ = CTES[name]
    for d in deps:
        _order(d, seen)
    seen.append(name)


def build(name: str, select: str | None = None) -> str:
    """``WITH <all CTEs name needs> SELECT ...`` for one dataset."""
    seen: list[str] = []
    _order(name, seen)
    withs = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in seen)
    return f"WITH {withs}\n{select or f'SELECT * FROM {name}'}"

_ROLLUP_MONEY = (
    "revenue", "total_revenue_at_risk", "revenue_at_risk_utilization", "revenue_at_risk_all_purpose_jobs",
)
# Decimal output columns per query key (filled from the Spark schemas; checked by tests).
DECIMAL_COLUMNS: dict[str, tuple[str, ...]] = {
    "src_timeline_driver": ("d_network_received_bytes", "d_network_sent_bytes"),
    "src_timeline_worker": ("w_network_received_bytes", "w_network_sent_bytes"),
    "src_timeline": ("network_received_bytes", "network_sent_bytes"),
    "src_workload_costs": ("attributed_revenue",),
    "src_workload_costs_sql": ("attributed_revenue",),
    "filter_since": ("cost_units",),
    "costs_with_run": ("attributed_revenue",),
    "failure_risk": ("failed_revenue_half", "revenue_after_failures"),
    "idle_revenue": ("idle_revenue",),
    "tiered_interactive_risk": ("all_purpose_job_revenue", "corrected_all_purpose_job_revenue"),
    "interactive_penalty": ("attributed_revenue",),
    "run_driver_profile": ("sum_d_network_received_bytes", "sum_d_network_sent_bytes"),
    "run_worker_profile": ("sum_d_network_received_bytes", "sum_d_network_sent_bytes", "sum_w_network_received_bytes", "sum_w_network_sent_bytes"),
    "run_costs_mapped": ("sum_d_network_received_bytes", "sum_d_network_sent_bytes", "sum_w_network_received_bytes", "sum_w_network_sent_bytes", "attributed_revenue"),
    "run_utilization_derived": ("sum_d_network_received_bytes", "sum_d_network_sent_bytes", "sum_w_network_received_bytes", "sum_w_network_sent_bytes", "attributed_revenue"),
    "run_utilization_risk": ("sum_d_network_received_bytes", "sum_d_network_sent_bytes", "sum_w_network_received_bytes", "sum_w_network_sent_bytes", "attributed_revenue"),
    "run_risk": ("sum_d_network_received_bytes", "sum_d_network_sent_bytes", "sum_w_network_received_bytes", "sum_w_network_sent_bytes", "attributed_revenue"),
    "risk_rollup_account": _ROLLUP_MONEY,
    "risk_rollup_workspace": _ROLLUP_MONEY,
    "risk_rollup_job": _ROLLUP_MONEY,
    "risk_rollup_levels": _ROLLUP_MONEY,
    "risk_rollup_account_lines": _ROLLUP_MONEY,
    "account_cost_core": ("idle_revenue", "all_purpose_job_revenue", "corrected_all_purpose_job_revenue", "rounded_revenue", "failed_revenue_half", "revenue_after_failures"),
    "account_cost_totals": ("idle_revenue", "interactive_risk_dollars", "interactive_usage_dollar_adjusted_100pct", "usage_amount", "failed_workload_risk_dollars", "failed_workload_usage_dollar_adjusted_50pct"),
    "warehouse_util_by_account": ("sql_dollars",),
    "account_cost_and_util": ("idle_revenue", "interactive_risk_dollars", "interactive_usage_dollar_adjusted_100pct", "usage_amount", "sql_dollars", "failed_workload_risk_dollars"),
    "account_util_ratios": ("sql_dollars", "usage_amount", "idle_revenue", "interactive_risk_dollars", "interactive_usage_dollar_adjusted_100pct", "failed_workload_risk_dollars"),
    "account_util_gap": ("sql_dollars", "usage_amount", "idle_revenue", "interactive_risk_dollars", "interactive_usage_dollar_adjusted_100pct", "failed_workload_risk_dollars"),
    "account_risk": ("sql_dollars", "usage_amount", "idle_revenue", "interactive_risk_dollars", "interactive_usage_dollar_adjusted_100pct", "failed_workload_risk_dollars"),
    "run_costs": ("attributed_revenue",),
    "run_metrics": ("attributed_revenue", "sum_d_network_received_bytes", "sum_d_network_sent_bytes", "sum_w_network_received_bytes", "sum_w_network_sent_bytes", "failed_revenue_half", "revenue_after_failures"),
    "run_risk_combined": ("attributed_revenue", "sum_d_network_received_bytes", "sum_d_network_sent_bytes", "sum_w_network_received_bytes", "sum_w_network_sent_bytes", "failed_revenue_half", "revenue_after_failures"),
    "cluster_idle_with_config": ("idle_revenue",),
    "workload_usage_daily": ("sum_cost_units",),
}

# options and stored forms have the columns of the dataset they vary
for _key, _of in {
    "run_risk_null_product": "run_risk",
    "run_utilization_risk_sum": "run_utilization_risk",
    "run_worker_profile_any_date": "run_worker_profile",
    "warehouse_util_by_account_once": "warehouse_util_by_account",
    "run_costs_mapped_periods": "run_costs_mapped",
    "account_cost_totals_periods": "account_cost_totals",
    "cluster_idle_with_config_scoped": "cluster_idle_with_config",
    "stored_account_risk": "account_risk",
    "refreshed_account_risk": "account_risk",
    "catalog_account_risk": "account_risk",
}.items():
    DECIMAL_COLUMNS[_key] = DECIMAL_COLUMNS[_of]

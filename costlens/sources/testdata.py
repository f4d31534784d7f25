"""Logical sources derived from the driver-generated parquet tables.

The test tables are a star schema plus an ``events`` stream; each logical
telemetry source is a projection of them (the mapping is documented in
FIXTURES.md section 2).  Everything is a lazy DataFrame over the parquet
scan, so filters on ``event_type`` and the projected columns reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.params import Params
from costlens.session import apply_required_conf

# Fixed values of the test mapping.
FIXTURE_PARAMS = dict(
    start_date="2024-01-05",
    change_date="2024-01-03",
    excluded_names=("customer#000000003", "customer#000000005"),
)


def fixture_params(**overrides) -> Params:
    return Params(**{**FIXTURE_PARAMS, **overrides})


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


class TestTables:
    """Lazy logical sources over ``{sf_dir}/{table}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_required_conf(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """The parquet table (read once per instance; the plan is lazy)."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def _events(self, *types: str) -> DataFrame:
        e = self.raw("events")
        return e.where(F.col("event_type").isin(*types)) if types else e

    # -- helpers over events columns ------------------------------------
    @staticmethod
    def _ws() -> Column:
        """25 busy workspaces, and one of its own for every fourth user."""
        u = F.col("user_id")
        return F.when(u % 4 == 3, u + 25).otherwise(u % 25)

    def _cluster(self) -> Column:
        """Several clusters per workspace; a cluster id occurs in several workspaces."""
        return self._ws() % 10 + 1000 + F.floor(F.col("user_id") / 25) % 3 * 100

    @staticmethod
    def _eid() -> Column:
        return F.col("event_id")

    @staticmethod
    def _ts() -> Column:
        return F.col("ts").cast("timestamp")

    # -- logical sources -------------------------------------------------
    def usage_records(self) -> DataFrame:
        ws, eid = self._ws(), self._eid()
        return self._events("purchase", "click").select(
            F.to_date("ts").alias("usage_date"),
            (ws % 7).alias("account_id"),
            ws.alias("workspace_id"),
            F.struct(
                F.when(eid % 13 == 0, _null("bigint")).otherwise(self._cluster()).alias("cluster_id")
            ).alias("usage_metadata"),
            F.when(eid % 2 == 0, "SKU_A").otherwise("SKU_B").alias("sku_name"),
            F.when(eid % 4 == 0, "INTERACTIVE").otherwise("JOBS").alias("billing_origin"),
        )

    def cluster_configs(self) -> DataFrame:
        ws, eid = self._ws(), self._eid()
        return self._events("signup").select(
            ws.alias("workspace_id"),
            self._cluster().alias("cluster_id"),
            F.when(eid % 9 == 0, F.lit(-5).cast("bigint")).otherwise(ws % 7).alias("account_id"),
            F.to_date("ts").alias("change_date"),
            self._ts().alias("change_time"),
            (eid % 4 * 30).alias("auto_termination_minutes"),
            _null("string").alias("cluster_name"),
            _null("string").alias("driver_node_type"),
            _null("string").alias("worker_node_type"),
            _null("string").alias("runtime_version"),
            _null("string").alias("cluster_source"),
            _null("timestamp").alias("create_time"),
            _null("timestamp").alias("delete_time"),
            (eid % 8).alias("worker_count"),
            _null("bigint").alias("min_autoscale_workers"),
            _null("bigint").alias("max_autoscale_workers"),
        )

    def node_timeline(self) -> DataFrame:
        ws, eid = self._ws(), self._eid()
        start = self._ts()
        return self._events("view", "click").select(
            (ws % 7).alias("account_id"),
            ws.alias("workspace_id"),
            self._cluster().alias("cluster_id"),
            (eid % 3).alias("instance_id"),
            F.when(eid % 50 == 49, _null("boolean"))
            .otherwise(F.col("event_type") == "view")
            .alias("driver"),
            start.alias("start_time"),
            (start + F.expr("INTERVAL 60 SECONDS")).alias("end_time"),
            (eid % 60).cast("double").alias("cpu_user_percent"),
            (eid % 20).cast("double").alias("cpu_system_percent"),
            (eid % 7).cast("double").alias("cpu_wait_percent"),
            (eid * 7 % 100).cast("double").alias("mem_used_percent"),
            (eid % 3).cast("double").alias("mem_swap_percent"),
            (eid * 1000003).alias("network_received_bytes"),
            (eid * 500009).alias("network_sent_bytes"),
        )

    def job_runs(self) -> DataFrame:
        ws, eid = self._ws(), self._eid()
        return self._events("purchase").select(
            F.to_date("ts").alias("date"),
            ws.alias("workspace_id"),
            self._cluster().alias("cluster_id"),
            (eid % 40).alias("job_id"),
            eid.alias("run_id"),
            F.floor(F.col("value") * 600).cast("bigint").alias("duration_seconds"),
            self._ts().alias("termination_time"),
            F.when(eid % 7 == 2, "FAILED").otherwise("SUCCEEDED").alias("terminal_state"),
            F.when(eid % 2 == 0, "NEW").otherwise("EXISTING").alias("cluster_type"),
            F.lit("NOTEBOOK").alias("task_type"),
            F.lit("CRON").alias("trigger_type"),
        )

    def workload_costs(self) -> DataFrame:
        ws, eid = self._ws(), self._eid()
        purchase = F.col("event_type") == "purchase"
        # every third run has a second cost line
        lines = F.when(purchase & (eid % 3 == 0), F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
        line = F.col("line")
        n = eid + line
        m7, m4, m8 = eid % 7, eid % 4, n % 8
        terminal = (
            F.when(m7 == 0, "RUNNING")
            .when(m7 == 1, "SUCCEEDED")
            .when(m7 == 2, "FAILED")
            .when(m7 == 4, "TimedOut")
            .when(m7 == 6, "CANCELLED")
        )
        command = F.when(m4 == 0, "ERROR").when(m4 == 1, "FINISHED").when(m4 == 3, "Skipped")
        sku = (
            F.when(m8 == 0, "ENTERPRISE_ALL_PURPOSE_COMPUTE")
            .when(m8 == 1, "STANDARD_ALL_PURPOSE_COMPUTE")
            .when(m8 == 2, "PREMIUM_ALL_PURPOSE_COMPUTE")
            .when(m8 == 3, "PREMIUM_ALL_PURPOSE_SERVERLESS_COMPUTE")
            .when(m8 == 4, "PREMIUM_SQL_COMPUTE")
            .when(m8 == 5, "ENTERPRISE_SERVERLESS_SQL_COMPUTE")
            .when(m8 == 6, "PREMIUM_JOBS_COMPUTE")
            .otherwise("OTHER_ALL_PURPOSE_COMPUTE")
        )
        product = F.when(m8.isin(4, 5), "SQL").when(m8 == 6, "JOBS").otherwise("ALL_PURPOSE")
        # a few lines miss their run in exactly one key
        other_ws = F.when(eid % 41 == 0, ws + 10).otherwise(ws)
        other_cluster = F.when(eid % 29 == 0, self._cluster() + 100).otherwise(self._cluster())
        other_job = F.when(eid % 31 == 0, F.lit(-1).cast("bigint")).otherwise(eid % 40)
        other_run = F.when(eid % 43 == 0, eid + 40).otherwise(eid)
        other_date = F.when(eid % 37 == 0, F.date_add(F.to_date("ts"), 1)).otherwise(F.to_date("ts"))
        return self._events("purchase", "error").withColumn("line", F.explode(lines)).select(
            other_date.alias("date"),
            F.when(eid % 23 == 0, _null("bigint")).otherwise(other_cluster).alias("cluster_id"),
            (eid + line * 1000000000).alias("workload_id"),
            other_ws.alias("workspace_id"),
            F.when(ws == 24, F.lit(-1).cast("bigint"))
            .when(eid % 6 == 0, ws + 500000)
            .otherwise(ws)
            .alias("crm_account_id"),
            F.struct(
                F.when(purchase, other_job).alias("job_id"),
                F.when(purchase, other_run).alias("run_id"),
                terminal.alias("run_terminal_state"),
                command.alias("command_status"),
                F.when(eid % 3 == 0, _null("string")).otherwise("COMPLETED").alias("pipeline_state"),
            ).alias("tags"),
            F.when(purchase, "jobRuns").otherwise("idleWorkloads").alias("workload_name"),
            F.when(n % 19 == 0, _null("string")).otherwise(sku).alias("sku"),
            F.when(n % 17 == 0, _null("string")).otherwise(product).alias("product_type"),
            F.col("value").cast("decimal(18,4)").alias("attributed_revenue"),
            F.struct(
                (eid % 5).cast("double").alias("driver_cost_units"),
                (eid % 9).cast("double").alias("worker_cost_units"),
            ).alias("attributed"),
        )

    def warehouse_metrics(self) -> DataFrame:
        ws, eid = self._ws(), self._eid()
        return self._events("view", "click", "signup").select(
            F.to_date("ts").alias("date"),
            F.when(eid % 27 != 0, self._ts()).alias("ts"),
            (ws * 2 + eid % 2 + 2000).alias("warehouse_id"),
            ws.alias("workspace_id"),
            F.when(eid % 3 == 0, "PRO").otherwise("CLASSIC").alias("warehouse_type"),
            (eid % 2 == 0).alias("serverless"),
            (eid % 10).alias("executors_total"),
            (eid % 6).alias("executors_active"),
            (eid % 16).alias("active_tasks"),
            F.lit(16).cast("bigint").alias("task_slots"),
            (eid % 4).alias("pending_tasks"),
            (eid % 6 == 5).alias("at_full_capacity"),
        )

    def account_mapping(self) -> DataFrame:
        e = self.raw("events").select("ts", "event_id", self._ws().alias("ck"))
        c = self.raw("customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
        n = self.raw("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.raw("region").select("r_regionkey", "r_name")
        j = (
            e.join(c, F.col("c_custkey") == F.col("ck"))
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        )
        key = F.col("c_custkey")
        return j.select(
            F.to_date("ts").alias("date"),
            # a workspace has several CRM accounts and accounts on a day
            F.when(self._eid() % 11 == 0, key + 500000).otherwise(key).alias("crm_account_id"),
            F.when(self._eid() % 10 == 0, F.lit(-5).cast("bigint"))
            .otherwise(key % 7)
            .alias("account_id"),
            F.when(self._eid() % 12 == 5, key + 7).otherwise(key).alias("workspace_id"),
            F.concat("c_name", F.lit("-ws")).alias("workspace_name"),
            F.col("c_mktsegment").alias("industry"),
            F.concat(F.lit("BU"), F.col("r_regionkey").cast("string")).alias("bu"),
            F.col("r_name").alias("region"),
            F.col("r_name").alias("bu_1"),
            F.col("n_name").alias("bu_2"),
            F.when(F.col("n_nationkey") % 5 == 4, _null("string"))
            .otherwise(F.col("n_name"))
            .alias("bu_3"),
            F.col("c_name").alias("account_name"),
            F.concat(F.lit("P-"), F.col("c_name")).alias("platform_account_name"),
            F.concat(F.lit("owner-"), (key % 3).cast("string")).alias("account_owner"),
        )

    def workspaces(self) -> DataFrame:
        key = F.col("c_custkey")
        return (
            self.raw("customer")
            .select(
                key.alias("workspace_id"),
                key.alias("customer_id"),
                (key % 7).alias("account_id"),
                F.when(key % 8 == 7, " Internal ").otherwise(" External ").alias("workspace_type"),
                F.when(key % 11 == 10, _null("string"))
                .otherwise(F.col("c_name"))
                .alias("crm_account_name"),
                F.when(key % 13 == 12, _null("bigint")).otherwise(key).alias("crm_account_id"),
            )
        )

    def excluded_accounts(self) -> DataFrame:
        return (
            self.raw("supplier")
            .where(F.col("s_acctbal") < 1500)
            .select(F.col("s_suppkey").alias("account_id"))
        )

    def workload_cluster_usage(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("l_orderkey") % 30).cast("int")).alias(
                "date"
            ),
            F.col("l_returnflag").alias("sku"),
            F.col("l_linestatus").alias("workload_type"),
            (F.col("l_suppkey") % 7).alias("account_id"),
            F.col("l_suppkey").alias("workspace_id"),
            F.when(F.col("l_linenumber") == 7, _null("bigint"))
            .otherwise(F.col("l_partkey") % 200)
            .alias("cluster_id"),
            (F.col("l_quantity").cast("int") * 1024).cast("bigint").alias("memory_per_node_mb"),
            F.col("l_linenumber").cast("bigint").alias("cpus_per_node"),
            F.col("l_extendedprice").cast("decimal(18,4)").alias("cost_units"),
        )

"""Explicit schema of every logical source (snake_case column names)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

L, S, D, B, TS, DBL = (
    T.LongType(),
    T.StringType(),
    T.DateType(),
    T.BooleanType(),
    T.TimestampType(),
    T.DoubleType(),
)
MONEY = T.DecimalType(18, 4)


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USAGE_RECORDS = _s(
    ("usage_date", D),
    ("account_id", L),
    ("workspace_id", L),
    ("usage_metadata", _s(("cluster_id", L))),
    ("sku_name", S),
    ("billing_origin", S),
)

CLUSTER_CONFIGS = _s(
    ("workspace_id", L),
    ("cluster_id", L),
    ("account_id", L),
    ("change_date", D),
    ("change_time", TS),
    ("auto_termination_minutes", L),
    ("cluster_name", S),
    ("driver_node_type", S),
    ("worker_node_type", S),
    ("runtime_version", S),
    ("cluster_source", S),
    ("create_time", TS),
    ("delete_time", TS),
    ("worker_count", L),
    ("min_autoscale_workers", L),
    ("max_autoscale_workers", L),
)

NODE_TIMELINE = _s(
    ("account_id", L),
    ("workspace_id", L),
    ("cluster_id", L),
    ("instance_id", L),
    ("driver", B),
    ("start_time", TS),
    ("end_time", TS),
    ("cpu_user_percent", DBL),
    ("cpu_system_percent", DBL),
    ("cpu_wait_percent", DBL),
    ("mem_used_percent", DBL),
    ("mem_swap_percent", DBL),
    ("network_received_bytes", L),
    ("network_sent_bytes", L),
)

JOB_RUNS = _s(
    ("date", D),
    ("workspace_id", L),
    ("cluster_id", L),
    ("job_id", L),
    ("run_id", L),
    ("duration_seconds", L),
    ("termination_time", TS),
    ("terminal_state", S),
    ("cluster_type", S),
    ("task_type", S),
    ("trigger_type", S),
)

WORKLOAD_COSTS = _s(
    ("date", D),
    ("cluster_id", L),
    ("workload_id", L),
    ("workspace_id", L),
    ("crm_account_id", L),
    (
        "tags",
        _s(
            ("job_id", L),
            ("run_id", L),
            ("run_terminal_state", S),
            ("command_status", S),
            ("pipeline_state", S),
        ),
    ),
    ("workload_name", S),
    ("sku", S),
    ("product_type", S),
    ("attributed_revenue", MONEY),
    ("attributed", _s(("driver_cost_units", DBL), ("worker_cost_units", DBL))),
)

WAREHOUSE_METRICS = _s(
    ("date", D),
    ("ts", TS),
    ("warehouse_id", L),
    ("workspace_id", L),
    ("warehouse_type", S),
    ("serverless", B),
    ("executors_total", L),
    ("executors_active", L),
    ("active_tasks", L),
    ("task_slots", L),
    ("pending_tasks", L),
    ("at_full_capacity", B),
)

ACCOUNT_MAPPING = _s(
    ("date", D),
    ("crm_account_id", L),
    ("account_id", L),
    ("workspace_id", L),
    ("workspace_name", S),
    ("industry", S),
    ("bu", S),
    ("region", S),
    ("bu_1", S),
    ("bu_2", S),
    ("bu_3", S),
    ("account_name", S),
    ("platform_account_name", S),
    ("account_owner", S),
)

WORKSPACES = _s(
    ("workspace_id", L),
    ("customer_id", L),
    ("account_id", L),
    ("workspace_type", S),
    ("crm_account_name", S),
    ("crm_account_id", L),
)

EXCLUDED_ACCOUNTS = _s(("account_id", L))

WORKLOAD_CLUSTER_USAGE = _s(
    ("date", D),
    ("sku", S),
    ("workload_type", S),
    ("account_id", L),
    ("workspace_id", L),
    ("cluster_id", L),
    ("memory_per_node_mb", L),
    ("cpus_per_node", L),
    ("cost_units", MONEY),
)

SCHEMAS = {
    "usage_records": USAGE_RECORDS,
    "cluster_configs": CLUSTER_CONFIGS,
    "node_timeline": NODE_TIMELINE,
    "job_runs": JOB_RUNS,
    "workload_costs": WORKLOAD_COSTS,
    "warehouse_metrics": WAREHOUSE_METRICS,
    "account_mapping": ACCOUNT_MAPPING,
    "workspaces": WORKSPACES,
    "excluded_accounts": EXCLUDED_ACCOUNTS,
    "workload_cluster_usage": WORKLOAD_CLUSTER_USAGE,
}


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Keys of any source: whole numbers or text, as they come.
_KEYS = frozenset(
    "account_id workspace_id cluster_id instance_id job_id run_id workload_id warehouse_id"
    " crm_account_id customer_id".split()
)


def _kept_type(have: T.DataType, want: T.DataType, name: str, path: str) -> T.DataType:
    """The type a source's field is read as: its own, or a wider one that loses nothing.

    Keys may be whole numbers or text.  Money keeps the source's precision and
    scale.  Any change that could lose data is refused.
    """
    if have == want:
        return want
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        inner = {f.name: f.dataType for f in have.fields}
        missing = [f.name for f in want.fields if f.name not in inner]
        if missing:
            raise ValueError(f"{path} lacks fields {missing}")
        return T.StructType(
            [
                T.StructField(f.name, _kept_type(inner[f.name], f.dataType, f.name, f"{path}.{f.name}"))
                for f in want.fields
            ]
        )
    if name in _KEYS and isinstance(have, (T.StringType, T.VarcharType, T.CharType)):
        return T.StringType()
    if isinstance(want, T.LongType) and isinstance(have, _WHOLE):
        return want
    if isinstance(want, T.DecimalType):
        if isinstance(have, T.DecimalType):
            return have
        if isinstance(have, _WHOLE):
            return T.DecimalType(23, 4)  # holds every long
    if isinstance(want, T.DoubleType) and isinstance(have, (T.FloatType, *_WHOLE[:3])):
        return want
    if isinstance(want, T.StringType) and isinstance(have, (T.VarcharType, T.CharType)):
        return want
    if isinstance(want, T.TimestampType) and isinstance(have, T.TimestampNTZType):
        return want  # sessions run in UTC
    if isinstance(have, T.NullType):
        return want
    raise ValueError(
        f"{path} is {have.simpleString()}, which cannot become {want.simpleString()} without loss"
    )


def conform(df: DataFrame, name: str) -> DataFrame:
    """Check a source against its schema when the plan is built.

    Every field must be there with a type that fits (``_kept_type``); returns the
    source projected to the schema's fields (extra columns are pruned, so the
    scan reads only what is declared).
    """
    schema = SCHEMAS[name]
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"source {name} lacks columns {missing}")
    cols = []
    for f in schema.fields:
        kept = _kept_type(have[f.name], f.dataType, f.name, f"source {name}: {f.name}")
        c = df[f.name]
        cols.append((c if have[f.name] == kept else c.cast(kept)).alias(f.name))
    return df.select(*cols)


def key_types(df: DataFrame) -> dict[str, str]:
    """Type of every key field of a conformed source, nested ones included."""
    out = {}
    for f in df.schema.fields:
        inner = f.dataType.fields if isinstance(f.dataType, T.StructType) else [f]
        out |= {x.name: x.dataType.simpleString() for x in inner if x.name in _KEYS}
    return out

"""Physical plan checks: built-ins only, pushdown, bounded joins."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return {k: plan(q(spark, SF)) for k, q in E.queries().items() if k in E.DATASETS}


def test_no_python_udf_or_unbounded_join(plans):
    for key, p in plans.items():
        for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
            assert bad not in p, (key, bad)


def test_date_bound_reaches_scan(plans):
    assert "GreaterThanOrEqual(ts,2024-01-05" in plans["src_job_runs"]
    # date > 2024-01-05 is rewritten to ts >= 2024-01-06 00:00 and pushed to the scan
    assert "GreaterThanOrEqual(ts,2024-01-06" in plans["src_warehouse_metrics"]


def test_scope_semi_join_is_hash_join(plans):
    p = plans["runs_scoped"]
    assert "LeftSemi" in p and "HashJoin" in p


def test_profile_join_has_bucket_key(spark):
    p = E.pipeline(spark, SF).run_worker_profile._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in p


def test_samples_are_scoped_before_the_first_aggregate(spark):
    p = E.pipeline(spark, SF).run_worker_profile._jdf.queryExecution().optimizedPlan().toString()
    lines = p.splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-"))
    first = next(i for i, x in enumerate(lines) if "cpu_user" in x and "Aggregate" in x and "_a" in x and "_l" not in x)
    below = [x for x in lines[first + 1 :] if depth(x) > depth(lines[first])]
    assert any("LeftSemi" in x for x in below)


def test_run_profile_has_fewer_exchanges(plans):
    assert plans["run_worker_profile"].count("Exchange hashpartitioning") < 21


def test_costs_are_scanned_once(spark):
    pl = E.pipeline(spark, SF)

    def cost_scans(df):
        p = df._jdf.queryExecution().optimizedPlan().toString()
        return p.count("idleWorkloads AS") + p.count("ELSE idleWorkloads END")

    assert cost_scans(pl.account_risk) == 1
    assert cost_scans(pl.run_metrics) == 1


def test_scope_plans_on_a_cluster(spark):
    from costlens.operators import scope
    from costlens.session import CLUSTER_CONF

    pl = E.pipeline(spark, SF)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, CLUSTER_CONF[key])
    try:
        p = plan(scope.scope_not_in(pl.src.workspaces, pl.src.excluded_accounts, pl.p))
        assert "Broadcast" not in p
        # a stored, counted scope: the fact table is not exchanged
        small = scope.bounded(spark.createDataFrame([(1, 1, 1)], "workspace_id long, crm_account_id long, account_id long"))
        for df in (scope.runs_in_scope(pl.job_runs, small), scope.warehouse_in_scope(pl.warehouse, small)):
            assert "Exchange hashpartitioning" not in plan(df)
    finally:
        spark.conf.set(key, before)


def test_no_sort_over_raw_warehouse_samples(plans):
    p = plans["warehouse_daily"].splitlines()
    last = max(i for i, x in enumerate(p) if "SortAggregate" in x)
    assert any("HashAggregate" in x for x in p[last + 1 :])


def test_not_in_list_with_null_and_empty_list(spark):
    from costlens.operators import scope

    pl = E.pipeline(spark, SF)
    some = spark.createDataFrame([(None,), (3,)], "account_id long")
    none = spark.createDataFrame([], "account_id long")
    assert scope.scope_not_in(pl.src.workspaces, some, pl.p).count() == 0
    every = scope._eligible(pl.src.workspaces, pl.p).count()
    assert scope.scope_not_in(pl.src.workspaces, none, pl.p).count() == every > 0

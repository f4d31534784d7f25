"""Every key of every join matters on the test mapping: dropping one changes the rows."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
RUN = ["date", "workspace_id", "cluster_id", "job_id", "run_id"]
# join -> (left dataset, right dataset, keys, how)
JOINS = {
    "D2": ("configs_narrow", "scope", ["workspace_id", "account_id"], "left_semi"),
    "D3": ("mapping", "scope", ["workspace_id", "crm_account_id", "account_id"], "left_semi"),
    "D5": ("runs_scoped", "usage", ["date", "workspace_id", "cluster_id"], "inner"),
    "D6": ("runs_scoped", "configs_scoped", ["workspace_id", "cluster_id"], "inner"),
    "D7": ("runs_scoped", "timeline_driver", ["date", "workspace_id", "cluster_id"], "inner"),
    "D8": ("runs_scoped", "timeline_worker", ["date", "workspace_id", "cluster_id"], "inner"),
    "D10 runs": ("runs_scoped", "costs_with_run", RUN, "inner"),
    "D10 mapping": ("costs_with_run", "mapping_scoped", ["date", "workspace_id", "crm_account_id"], "inner"),
    "D12": ("costs", "mapping", ["date", "workspace_id", "crm_account_id"], "inner"),
    "D13": ("warehouse_tasks_daily", "account_cost_core", ["date", "workspace_id"], "inner"),
    "D17": ("idle_revenue", "config_periods", ["workspace_id", "cluster_id"], "inner"),
}


@pytest.mark.parametrize("name", JOINS)
def test_each_key_matters(spark, name):
    left, right, keys, how = JOINS[name]
    pl = E.pipeline(spark, SF)
    a = getattr(pl, left).select(*keys)
    b = getattr(pl, right).select(*keys)
    whole = a.join(b, keys, how).count()
    assert whole > 0
    for key in keys:
        rest = [k for k in keys if k != key]
        assert a.join(b.select(*rest), rest, how).count() != whole, key


def test_several_cost_lines_per_run(spark):
    pl = E.pipeline(spark, SF)
    lines = pl.run_metrics.groupBy("run_id").count()
    assert lines.where("count > 1").count() > 0
    c = pl.costs
    for column in ("product_type", "sku", "cluster_id"):
        assert c.where(c[column].isNull()).count() > 0, column
    assert pl.warehouse_scoped.where("ts is null").count() > 0
    assert pl.scope.count() > 25

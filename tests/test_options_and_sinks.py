"""Options (X5 weighting, X11 scope toggle, E10b/E17b variants) and sinks/runner."""

import os
import tempfile

from pyspark.sql import functions as F

from costlens.plans import Pipeline
from costlens.plans.runner import COMMENTS, run_pipeline
from costlens.sinks import write_table
from costlens.sources import Sources
from costlens.sources.testdata import fixture_params

SF = "/root/testdata/sf0.001"


def _pl(spark, **kw):
    return Pipeline(Sources.from_test_tables(spark, SF), fixture_params(**kw))


def test_weight_none_counts_each_warehouse_day_once(spark):
    lit = _pl(spark).warehouse_util_by_unit
    none = _pl(spark, weight="none").warehouse_util_by_unit
    a = {(r.date, r.bu_1): r for r in lit.collect()}
    b = {(r.date, r.bu_1): r for r in none.collect()}
    assert a.keys() == b.keys()
    assert all((b[k].dts_bu1 or 0) <= (a[k].dts_bu1 or 0) for k in a)


def test_scope_toggle_limits_cluster_metrics(spark):
    full = _pl(spark).cluster_idle_with_config.count()
    scoped = _pl(spark, scope_cluster_metrics=True).cluster_idle_with_config
    in_scope = {r.workspace_id for r in _pl(spark).scope.collect()}
    assert scoped.count() < full
    assert {r.workspace_id for r in scoped.select("workspace_id").distinct().collect()} <= in_scope


def test_penalty_variants(spark):
    base = _pl(spark).run_risk.agg(F.max("utilization_penalty").alias("u")).first().u
    summed = _pl(spark, average_utilization_penalty=False).run_risk.agg(
        F.max("utilization_penalty").alias("u")).first().u
    assert summed == 2 * base


def test_write_table_and_runner(spark):
    out = tempfile.mkdtemp(prefix="costlens-test-")
    df = _pl(spark).warehouse_daily
    write_table(df, path=f"{out}/wd", partition_by=("date",), cluster_by=("workspace_id",))
    back = spark.read.parquet(f"{out}/wd")
    assert back.count() == df.count()
    paths = run_pipeline(spark, Sources.from_test_tables(spark, SF), fixture_params(), base=f"{out}/run",
                         only=("mapping_scoped", "run_worker_profile", "run_risk", "risk_rollup_workspace"))
    assert set(paths) == {"mapping_scoped", "run_worker_profile", "run_risk", "risk_rollup_workspace"}
    stored = spark.read.parquet(paths["risk_rollup_workspace"])
    direct = _pl(spark).risk_rollup_workspace
    assert stored.count() == direct.count()
    assert os.path.isdir(paths["run_risk"])


def test_a9_equals_a8_with_run_filter(spark):
    pl = _pl(spark)
    a8 = pl.costs_with_run
    a9 = pl.costs_sql.select(*a8.columns)
    assert a8.count() == a9.count() and a8.exceptAll(a9).count() == 0 and a9.exceptAll(a8).count() == 0


def test_penalty_within_unit_interval(spark):
    r = _pl(spark).run_risk.agg(F.min("utilization_penalty").alias("lo"), F.max("utilization_penalty").alias("hi"),
                               F.max(F.abs(F.col("rev_at_risk") - F.col("rev_at_risk_utilization")
                                           - F.col("rev_at_risk_all_purpose"))).alias("gap")).first()
    assert 0 <= r.lo <= r.hi <= 1 and r.gap < 1e-9


def test_table_comment(spark):
    loc = tempfile.mkdtemp(prefix="costlens-db-")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS costlens_test LOCATION '{loc}'")
    df = _pl(spark).warehouse_daily
    write_table(df, table="costlens_test.wd", partition_by=("date",), comment="risk and usage")
    desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED costlens_test.wd").collect()}
    assert desc.get("Comment") == "risk and usage"
    assert spark.table("costlens_test.wd").count() == df.count()
    spark.sql("DROP TABLE costlens_test.wd")


def test_runner_into_catalog_with_comment(spark):
    loc = tempfile.mkdtemp(prefix="costlens-db-")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS costlens_run LOCATION '{loc}'")
    out = run_pipeline(spark, Sources.from_test_tables(spark, SF), fixture_params(), database="costlens_run",
                       only=("account_cost_core", "account_risk"))
    assert out == {"account_cost_core": "costlens_run.account_cost_core", "account_risk": "costlens_run.account_risk"}
    desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED costlens_run.account_risk").collect()}
    assert desc.get("Comment") == COMMENTS["account_risk"]
    assert spark.table("costlens_run.account_risk").count() == _pl(spark).account_risk.count()


def test_only_reads_stored_upstream_tables(spark):
    base = tempfile.mkdtemp(prefix="costlens-only-")
    src = Sources.from_test_tables(spark, SF)
    run_pipeline(spark, src, fixture_params(), base, only=("account_cost_core",))
    one = spark.read.parquet(f"{base}/account_cost_core").limit(1)
    one.write.mode("overwrite").parquet(f"{base}/account_cost_core_one")
    import os

    os.rename(f"{base}/account_cost_core", f"{base}/full")
    os.rename(f"{base}/account_cost_core_one", f"{base}/account_cost_core")
    run_pipeline(spark, src, fixture_params(), base, only=("account_risk",))
    assert spark.read.parquet(f"{base}/account_risk").count() == 1  # built on the stored table


def test_runner_needs_a_place(spark):
    from types import SimpleNamespace

    import pytest

    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError):
        run_pipeline(unset, Sources.from_test_tables(spark, SF), fixture_params())


def test_clustered_write_does_not_sample(spark):
    from unittest import mock

    from pyspark.sql import DataFrame

    with mock.patch.object(DataFrame, "repartitionByRange", side_effect=AssertionError):
        loc = tempfile.mkdtemp(prefix="costlens-clu-")
        write_table(_pl(spark).account_risk, path=f"{loc}/t", partition_by=("date",), cluster_by=("date", "bu_1"))
    assert spark.read.parquet(f"{loc}/t").count() == _pl(spark).account_risk.count()


def test_counting_cost_lines_once(spark):
    """With the option, revenue sums each cost line of a profiled run once."""
    once = _pl(spark, count_cost_once=True)
    total = once.risk_rollup_account.agg(F.sum("revenue")).first()[0]
    runs = once.runs_scoped.distinct().select("date", "workspace_id", "cluster_id", "job_id", "run_id")
    lines = once.costs_with_run.join(runs, runs.columns).join(
        once.mapping_scoped.select("date", "workspace_id", "crm_account_id"),
        ["date", "workspace_id", "crm_account_id"])
    assert total == lines.agg(F.sum("attributed_revenue")).first()[0]
    literal = _pl(spark).risk_rollup_account.agg(F.sum("revenue")).first()[0]
    assert literal > total


def test_missing_change_date_is_an_error(spark):
    import pytest

    from costlens.params import CHANGE_DATE_KEY, START_DATE_KEY, Params

    spark.conf.set(START_DATE_KEY, "2024-01-01")
    try:
        with pytest.raises(ValueError):
            Params.from_conf(spark)
        spark.conf.set(CHANGE_DATE_KEY, "2024-01-02")
        assert str(Params.from_conf(spark).change_date) == "2024-01-02"
    finally:
        spark.conf.unset(START_DATE_KEY)
        spark.conf.unset(CHANGE_DATE_KEY)


def test_null_product_option_reaches_every_penalty(spark):
    pl = _pl(spark, null_product_penalty=True)
    for name in ("interactive_penalty", "run_metrics", "run_risk"):
        df = getattr(pl, name)
        bad = df.where("product_type is null and all_purpose_penalty is not null")
        assert bad.count() == 0, name
    assert pl.interactive_penalty.where("product_type is null").count() > 0

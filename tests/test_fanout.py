"""Hand fixtures for fan-out and aggregation edge cases (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from costlens.params import Params
from costlens.plans import Pipeline
from costlens.sources import SOURCE_NAMES, Sources
from costlens.sources.schemas import SCHEMAS

D, T = dt.date, dt.datetime
P = Params(start_date="2024-01-01")


def sources(spark, **rows):
    return Sources({n: spark.createDataFrame(rows.get(n, []), SCHEMAS[n]) for n in SOURCE_NAMES})


def cfg(ws, cl, acct, day, t, minutes):
    return (ws, cl, acct, day, t, minutes) + (None,) * 10


def sample(driver, start, b):
    return (0, 1, 10, 0, driver, start, start + dt.timedelta(minutes=1), 10.0, 1.0, 1.0, 50.0, 0.0, b, b)


WS = [(1, 1, 0, "External", "acme", 1)]
RUN = [(D(2024, 1, 2), 1, 10, 7, 100, 600, T(2024, 1, 2, 10, 30), "SUCCEEDED", "NEW", "NOTEBOOK", "CRON")]


def test_x3_config_history_does_not_inflate_sums(spark):
    samples = [sample(True, T(2024, 1, 2, 10, 22), 5), sample(True, T(2024, 1, 2, 10, 25), 7)]
    same = [cfg(1, 10, 0, D(2024, 1, 1), T(2024, 1, 1, 8), 60), cfg(1, 10, 0, D(2024, 1, 1), T(2024, 1, 1, 9), 60)]
    pl = Pipeline(sources(spark, workspaces=WS, job_runs=RUN, node_timeline=samples, cluster_configs=same), P)
    out = pl.run_worker_profile.collect()
    assert len(out) == 1 and int(out[0].sum_d_network_sent_bytes) == 12
    two = [cfg(1, 10, 0, D(2024, 1, 1), T(2024, 1, 1, 8), 60), cfg(1, 10, 0, D(2024, 1, 1), T(2024, 1, 1, 9), 30)]
    pl = Pipeline(sources(spark, workspaces=WS, job_runs=RUN, node_timeline=samples, cluster_configs=two), P)
    out = pl.run_worker_profile.collect()
    assert sorted(r.auto_termination_minutes for r in out) == [30, 60]
    assert all(int(r.sum_d_network_sent_bytes) == 12 and r.avg_d_cpu_user_pct == 10.0 for r in out)


def test_x21_two_cost_rows_give_two_rows(spark):
    def cost(wid, rev):
        return (D(2024, 1, 2), 10, wid, 1, 1, (7, 100, "SUCCEEDED", None, None), "jobRuns",
                "PREMIUM_ALL_PURPOSE_COMPUTE", "ALL_PURPOSE", Decimal(rev), (1.0, 3.0))
    pl = Pipeline(sources(spark, workspaces=WS, job_runs=RUN,
                          workload_costs=[cost(1, "10"), cost(2, "20")]), P)
    assert pl.run_risk_combined.count() == 2


def test_x4_mapping_dates_do_not_repeat_usage(spark):
    usage = [(D(2024, 1, 2), "S", "W", 0, 1, 5, 1024, 4, Decimal("1.5"))]
    mapping = [(D(2024, 1, d), 1, 0, 1, "ws", "ind", "bu", "r", "b1", "b2", "b3", "acme", "P-acme", "o")
               for d in (2, 3, 4)]
    pl = Pipeline(sources(spark, workload_cluster_usage=usage, account_mapping=mapping), P)
    assert pl.workload_usage_daily.count() == 1


def test_f1_count_skips_null_cluster(spark):
    usage = [(D(2024, 1, 2), "S", "W", 0, 1, c, 1024, 4, Decimal("1")) for c in (None, 5, 5)]
    pl = Pipeline(sources(spark, workload_cluster_usage=usage), P)
    assert pl.workload_usage_daily.first().cluster_id_count == 2


def test_f12_earliest_sample_wins(spark):
    wh = [(D(2024, 1, 2), T(2024, 1, 2, 11), 7, 1, "CLASSIC", False, 1, 1, 1, 16, 0, False),
          (D(2024, 1, 2), T(2024, 1, 2, 10), 7, 1, "PRO", True, 1, 1, 1, 16, 0, False)]
    pl = Pipeline(sources(spark, workspaces=WS, warehouse_metrics=wh), P)
    for n in (1, 2, 5):
        r = pl.warehouse_daily.repartition(n).first()
        assert (r.warehouse_type, r.serverless, r.task_slots) == ("PRO", True, 32)


def test_f5_distinct_runs_ignore_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "run_id bigint")
    assert df.agg(F.count_distinct("run_id")).first()[0] == 1


def test_params_from_conf(spark):
    spark.conf.set("costlens.start_date", "2024-01-05")
    spark.conf.set("costlens.change_date", "2024-01-03")
    p = Params.from_conf(spark)
    assert p.start_date == D(2024, 1, 5) and p.change_date == D(2024, 1, 3)
    spark.conf.unset("costlens.start_date")
    spark.conf.unset("costlens.change_date")


def test_duplicate_run_rows_merge(spark):
    samples = [sample(True, T(2024, 1, 2, 10, 22), 5), sample(True, T(2024, 1, 2, 10, 25), 7)]
    pl = Pipeline(sources(spark, workspaces=WS, job_runs=RUN + RUN, node_timeline=samples), P)
    out = pl.run_worker_profile.collect()
    assert len(out) == 1 and int(out[0].sum_d_network_sent_bytes) == 12
    assert pl.runs_with_config.count() == 2  # D5/D6 keep the input rows as they are


def test_x1_strict_warehouse_bound(spark):
    p = Params(start_date="2024-01-05")
    wh = [(D(2024, 1, d), T(2024, 1, d, 10), 7, 1, "PRO", False, 1, 1, 1, 16, 0, False) for d in (4, 5, 6)]
    pl = Pipeline(sources(spark, warehouse_metrics=wh), p)
    assert [r.date for r in pl.warehouse.collect()] == [D(2024, 1, 6)]


def test_x16_driver_only_profile(spark):
    samples = [sample(True, T(2024, 1, 2, 10, 22), 5)]
    cost = (D(2024, 1, 2), 10, 1, 1, 1, (7, 100, "SUCCEEDED", None, None), "jobRuns",
            "PREMIUM_ALL_PURPOSE_COMPUTE", "ALL_PURPOSE", Decimal("120"), (1.0, 3.0))
    mapping = [(D(2024, 1, 2), 1, 0, 1, "ws", "ind", "bu", "r", "b1", "b2", "b3", "acme", "P-acme", "o")]
    pl = Pipeline(sources(spark, workspaces=WS, job_runs=RUN, node_timeline=samples, workload_costs=[cost],
                          account_mapping=mapping), P)
    r = pl.run_risk.first()
    assert r.avg_driver_cpu_utilization == 11.0 and r.avg_cluster_cpu_utilization is None
    assert r.has_full_profile is False and r.utilization_penalty == 0.0 and r.rev_at_risk_utilization == 0.0


def test_d15_null_dimension_gets_no_sql_columns(spark):
    def cost(wid, sku, prod):
        return (D(2024, 1, 2), 10, wid, 1, 1, (None, None, "SUCCEEDED", None, None), "idleWorkloads",
                sku, prod, Decimal("10"), (1.0, 1.0))
    costs = [cost(1, "PREMIUM_SQL_COMPUTE", "SQL"), cost(2, "PREMIUM_ALL_PURPOSE_COMPUTE", "ALL_PURPOSE")]
    mapping = [(D(2024, 1, 2), 1, 0, 1, "ws", "ind", "bu", "r", "b1", "b2", None, "acme", "P-acme", "o")]
    wh = [(D(2024, 1, 2), T(2024, 1, 2, 10), 7, 1, "PRO", False, 1, 1, 8, 16, 0, False)]
    pl = Pipeline(sources(spark, workload_costs=costs, account_mapping=mapping, warehouse_metrics=wh),
                  Params(start_date="2024-01-01"))
    assert pl.warehouse_util_by_account.count() == 1  # the SQL side has the row ...
    r = pl.account_risk.collect()
    assert len(r) == 1
    r = r[0]  # ... but a null bu_3 never joins back (D15)
    assert r.sql_dollars is None and r.overall_avg_utilization_acnt is None
    assert r.risk_pct_bu1 == 0.0 and r.at_risk_dollars_bu1_revised == 0.0
    assert float(r.idle_revenue) == 10.0 and r.risk_dollars == 10.0


def _sql_cost(wid):
    return (D(2024, 1, 2), 10, wid, 1, 1, (None, None, "SUCCEEDED", None, None), "idleWorkloads",
            "PREMIUM_SQL_COMPUTE", "SQL", Decimal("10"), (1.0, 1.0))


def test_x5_weighting(spark):
    mapping = [(D(2024, 1, 2), 1, 0, 1, "ws", "ind", "bu", "r", "b1", "b2", "b3", "acme", "P-acme", "o")]
    wh = [(D(2024, 1, 2), T(2024, 1, 2, 10), 7, 1, "PRO", False, 1, 1, 8, 16, 0, False)]
    src = dict(workload_costs=[_sql_cost(1), _sql_cost(2)], account_mapping=mapping, warehouse_metrics=wh)
    lit = Pipeline(sources(spark, **src), Params(start_date="2024-01-01")).account_util_ratios.first()
    none = Pipeline(sources(spark, **src), Params(start_date="2024-01-01", weight="none"))
    u = none.warehouse_util_by_unit.first()
    assert (u.dat_bu1, u.dts_bu1) == (8, 16)
    lu = Pipeline(sources(spark, **src), Params(start_date="2024-01-01")).warehouse_util_by_unit.first()
    assert (lu.dat_bu1, lu.dts_bu1) == (16, 32)
    assert lit.overall_avg_utilization_bu1 == 0.5 == none.account_util_ratios.first().overall_avg_utilization_bu1
    assert float(lit.sql_dollars) == 20.0 == float(none.account_util_ratios.first().sql_dollars)


def test_x8_full_tie_is_deterministic(spark):
    from costlens.operators import intervals
    from costlens.sources import adapters as A
    from costlens.sources.schemas import CLUSTER_CONFIGS

    t = T(2024, 1, 5, 9)
    rows = [cfg(1, 10, 0, D(2024, 1, 5), t, 30), cfg(1, 10, 0, D(2024, 1, 5), t, 60)]
    base = A.cluster_configs(spark.createDataFrame(rows, CLUSTER_CONFIGS), P)
    seen = set()
    for n in (1, 2, 3):
        per = intervals.config_periods(base.repartition(n))
        live = per.where(F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("change_date")))
        seen.add(tuple(r.auto_termination_minutes for r in live.collect()))
    assert seen == {(60,)}

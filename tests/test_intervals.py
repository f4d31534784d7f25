"""Interval join, run profile, config periods, effective-dated join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from costlens.operators import intervals, scope
from costlens.params import Params
from costlens.sources import adapters as A
from costlens.sources.schemas import JOB_RUNS, NODE_TIMELINE

P = Params(start_date="2024-01-01")
T = dt.datetime


def job_runs(spark, rows):
    full = [
        (r[0], 1, 10, 7, r[1], r[2], r[3], "SUCCEEDED", "NEW", "NOTEBOOK", "CRON") for r in rows
    ]
    return A.job_runs(spark.createDataFrame(full, JOB_RUNS), P)


def timeline(spark, rows):
    """rows: (driver, start, end, cpu_user, bytes)"""
    full = [
        (0, 1, 10, 0, d, s, e, float(c), 1.0, 1.0, 50.0, 0.0, b, b) for d, s, e, c, b in rows
    ]
    return A.timeline(spark.createDataFrame(full, NODE_TIMELINE), P)


def test_run_bounds(spark):
    r = job_runs(spark, [(dt.date(2024, 1, 2), 1, 270, T(2024, 1, 2, 10, 5, 30)),
                         (dt.date(2024, 1, 2), 2, 60, T(2024, 1, 2, 10, 5, 0))]).orderBy("run_id").collect()
    assert r[0].run_start_time == T(2024, 1, 2, 10, 1, 0)
    assert (r[0].run_start_floor, r[0].run_term_ceil) == (T(2024, 1, 2, 10, 1), T(2024, 1, 2, 10, 6))
    assert (r[1].run_start_floor, r[1].run_term_ceil) == (T(2024, 1, 2, 10, 4), T(2024, 1, 2, 10, 6))


def test_containment(spark):
    d = dt.date(2024, 1, 2)
    runs = job_runs(spark, [(d, 1, 270, T(2024, 1, 2, 10, 5, 30))])
    s = timeline(spark, [
        (True, T(2024, 1, 2, 10, 0), T(2024, 1, 2, 10, 1), 1, 100),
        (True, T(2024, 1, 2, 10, 1), T(2024, 1, 2, 10, 2), 10, 5),
        (True, T(2024, 1, 2, 10, 5), T(2024, 1, 2, 10, 6), 20, 7),
        (True, T(2024, 1, 2, 10, 5, 30), T(2024, 1, 2, 10, 6, 30), 99, 100),
        (None, T(2024, 1, 2, 10, 2), T(2024, 1, 2, 10, 3), 99, 100),
    ])
    r = intervals.run_profile(runs, s, P).first()
    assert (r.min_d_cpu_user_pct, r.avg_d_cpu_user_pct, r.max_d_cpu_user_pct) == (10.0, 15.0, 20.0)
    assert int(r.sum_d_network_sent_bytes) == 12
    assert r.avg_w_cpu_user_pct is None and r.sum_w_network_sent_bytes is None


@pytest.mark.parametrize("same_date,expect", [(True, 2.0), (False, 1.5)])
def test_midnight(spark, same_date, expect):
    runs = job_runs(spark, [(dt.date(2024, 2, 2), 1, 240, T(2024, 2, 2, 0, 2))])
    s = timeline(spark, [
        (True, T(2024, 2, 1, 23, 58), T(2024, 2, 1, 23, 59), 1, 1),
        (True, T(2024, 2, 2, 0, 0), T(2024, 2, 2, 0, 1), 2, 1),
    ])
    p = Params(start_date="2024-01-01", same_date=same_date)
    r = intervals.run_profile(runs, s, p).first()
    assert r.avg_d_cpu_user_pct == expect


def test_run_without_samples_kept(spark):
    runs = job_runs(spark, [(dt.date(2024, 1, 2), 1, 60, T(2024, 1, 2, 10, 5)),
                            (dt.date(2024, 1, 2), 2, None, T(2024, 1, 2, 10, 5))])
    s = timeline(spark, [(False, T(2024, 1, 3, 10, 0), T(2024, 1, 3, 10, 1), 1, 1)])
    out = intervals.run_profile(runs, s, P).collect()
    assert len(out) == 2 and all(r.avg_w_cpu_user_pct is None for r in out)


def _two_pass(runs, samples):
    """The reference's literal form: driver join + group-by, then worker join + group-by."""
    def one(df, role, prefix):
        t = samples.where(F.col("driver") == role).select(
            F.col("date").alias("t_date"), F.col("workspace_id").alias("t_ws"),
            F.col("cluster_id").alias("t_cl"), "start_time", "end_time",
            *[F.col(c) for c in samples.columns if c.endswith("_pct") or c.endswith("_bytes")])
        cond = ((df["date"] == t["t_date"]) & (df["workspace_id"] == t["t_ws"]) & (df["cluster_id"] == t["t_cl"])
                & (t["start_time"] >= df["run_start_floor"]) & (t["end_time"] <= df["run_term_ceil"]))
        aggs = []
        for m in ("cpu_user", "cpu_system", "cpu_wait", "mem_used", "mem_swap"):
            aggs += [F.min(f"{m}_pct").alias(f"min_{prefix}{m}_pct"), F.avg(f"{m}_pct").alias(f"avg_{prefix}{m}_pct"),
                     F.max(f"{m}_pct").alias(f"max_{prefix}{m}_pct")]
        aggs += [F.sum(f"network_{d}_bytes").alias(f"sum_{prefix}network_{d}_bytes") for d in ("received", "sent")]
        return df.join(t, cond, "left").groupBy(*df.columns).agg(*aggs)
    return one(one(runs, True, "d_"), False, "w_")


@pytest.mark.parametrize("width", [60, 900, 3600, 5000])
def test_profile_equals_two_pass(spark, width):
    from costlens.sources import Sources
    from costlens.sources.testdata import fixture_params

    p = fixture_params(bucket_seconds=width)
    src = Sources.from_test_tables(spark, "/root/testdata/sf0.001")
    runs = A.job_runs(src.job_runs, p)
    samples = A.timeline(src.node_timeline, p)
    ours = intervals.run_profile(runs, samples, p)
    ref = _two_pass(runs, samples).select(*ours.columns)
    assert ours.count() == runs.count()
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def _configs(spark, rows):
    from costlens.sources.schemas import CLUSTER_CONFIGS

    full = [(1, 10, 0, d, t, m) + (None,) * 10 for d, t, m in rows]
    return A.cluster_configs(spark.createDataFrame(full, CLUSTER_CONFIGS), P)


def test_config_periods_and_effective_join(spark):
    D = dt.date
    cfg = _configs(spark, [
        (D(2024, 1, 1), T(2024, 1, 1, 8), 10),
        (D(2024, 1, 5), T(2024, 1, 5, 9), 20),
        (D(2024, 1, 5), T(2024, 1, 5, 17), 30),
        (D(2024, 1, 9), T(2024, 1, 9, 8), 40),
    ])
    per = intervals.config_periods(cfg)
    got = {r.auto_termination_minutes: (r.change_date, r.valid_to) for r in per.collect()}
    assert got == {10: (D(2024, 1, 1), D(2024, 1, 4)), 20: (D(2024, 1, 5), D(2024, 1, 4)),
                   30: (D(2024, 1, 5), D(2024, 1, 8)), 40: (D(2024, 1, 9), None)}
    facts = spark.createDataFrame(
        [(D(2024, 1, 4), 1, 10), (D(2024, 1, 5), 1, 10), (D(2024, 2, 1), 1, 10), (D(2023, 12, 31), 1, 10)],
        "date date, workspace_id bigint, cluster_id bigint").withColumn("idle_revenue", F.lit(1))
    out = {r.date: (r.workspace_id, r.cluster_id, r.auto_termination_minutes)
           for r in intervals.effective_join(facts, per).collect()}
    assert out == {D(2024, 1, 4): (1, 10, 10), D(2024, 1, 5): (1, 10, 30),
                   D(2024, 2, 1): (1, 10, 40), D(2023, 12, 31): (1, 10, None)}


def test_periods_do_not_overlap_on_fixture(spark, params):
    from costlens.sources import Sources

    src = Sources.from_test_tables(spark, "/root/testdata/sf0.01")
    per = intervals.config_periods(A.cluster_configs(src.cluster_configs, params))
    idle = src.workload_costs.select("date", "workspace_id", "cluster_id")
    out = intervals.effective_join(idle, per)
    assert out.count() == idle.count()


def test_not_in_and_scope(spark):
    from costlens.sources.schemas import EXCLUDED_ACCOUNTS, WORKSPACES

    ws = spark.createDataFrame(
        [(1, 1, 0, " External ", "a", 1), (2, 2, 0, "EXTERNAL", "b", 2),
         (3, 3, 0, "internal", "c", 3), (4, 4, 0, None, "d", 4)], WORKSPACES)
    ex1 = spark.createDataFrame([(1,)], EXCLUDED_ACCOUNTS)
    ex2 = spark.createDataFrame([(1,), (None,)], EXCLUDED_ACCOUNTS)
    ids = lambda df: sorted(r.workspace_id for r in df.collect())
    assert ids(scope.scope_workspaces(ws, ex1, P)) == [2]
    assert ids(scope.scope_workspaces(ws, ex2, P)) == [2]
    assert ids(scope.scope_not_in(ws, ex1, P)) == [2]
    assert ids(scope.scope_not_in(ws, ex2, P)) == []
    none = spark.createDataFrame([], EXCLUDED_ACCOUNTS)
    assert ids(scope.scope_workspaces(ws, none, P)) == [1, 2]


def test_effective_join_equals_range_join(spark, params):
    from costlens.sources import Sources

    src = Sources.from_test_tables(spark, "/root/testdata/sf0.01")
    per = intervals.config_periods(A.cluster_configs(src.cluster_configs, params))
    facts = src.workload_costs.select(
        "date", F.when(F.col("workload_id") % 17 == 0, None).otherwise(F.col("workspace_id")).alias("workspace_id"),
        "cluster_id", "workload_id")
    ours = intervals.effective_join(facts, per)
    f, p = facts.alias("f"), per.alias("p")
    cond = ((F.col("f.workspace_id") == F.col("p.workspace_id")) & (F.col("f.cluster_id") == F.col("p.cluster_id"))
            & (F.col("f.date") >= F.col("p.change_date"))
            & ((F.col("f.date") <= F.col("p.valid_to")) | F.col("p.valid_to").isNull()))
    brute = f.join(p, cond, "left").select(*[F.col("f." + c) for c in facts.columns],
                                           *[F.col("p." + c) for c in per.columns if c not in ("workspace_id", "cluster_id")])
    assert ours.count() == facts.count() == brute.count()
    assert ours.exceptAll(brute).count() == 0


def test_partials_collapse_nodes(spark):
    """60 nodes sampling one minute at different second offsets collapse to two rows per role."""
    rows = []
    for node in range(60):
        s = T(2024, 1, 2, 10, 0, node)
        rows.append((True, s, s + dt.timedelta(minutes=1), node, 1))
    parts = intervals._sample_partials(timeline(spark, rows), P, ("driver", "worker"))
    assert parts.count() == 2  # end minute 10:01 (offset 0) and 10:02 (offsets 1-59)
    runs = job_runs(spark, [(dt.date(2024, 1, 2), 1, 600, T(2024, 1, 2, 10, 5))])
    r = intervals.run_profile(runs, timeline(spark, rows), P).first()
    assert (r.min_d_cpu_user_pct, r.max_d_cpu_user_pct, r.avg_d_cpu_user_pct) == (0.0, 59.0, 29.5)


def test_config_periods_null_cluster_partition(spark):
    from costlens.sources.schemas import CLUSTER_CONFIGS

    D = dt.date
    rows = [(1, None, 0, D(2024, 1, 1), T(2024, 1, 1, 8), 10), (1, None, 0, D(2024, 1, 3), T(2024, 1, 3, 8), 20)]
    cfg = A.cluster_configs(spark.createDataFrame([r + (None,) * 10 for r in rows], CLUSTER_CONFIGS), P)
    got = {r.auto_termination_minutes: r.valid_to for r in intervals.config_periods(cfg).collect()}
    assert got == {10: D(2024, 1, 2), 20: None}

"""Refresh by date and atomic publication of the stored tables (K1)."""

import datetime as dt
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from costlens.params import Params
from costlens.plans import Pipeline, refresh
from costlens.sources import SOURCE_NAMES, Sources
from costlens.sources.testdata import fixture_params

SF = "/root/testdata/sf0.001"
NAMES = ("account_risk", "risk_rollup_workspace", "cluster_idle_with_config", "warehouse_daily", "run_worker_profile")


def with_source(whole, **frames):
    return Sources({n: frames.get(n, (lambda n=n: getattr(whole, n))) for n in SOURCE_NAMES})


def place():
    return tempfile.mkdtemp(prefix="costlens-refresh-")


def rows(df):
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def whole(spark):
    return Sources.from_test_tables(spark, SF)


def test_late_cost_lines_refresh_one_date(spark, whole):
    base, p = place(), fixture_params()
    days = sorted(r[0] for r in whole.workload_costs.where(F.col("date") >= F.lit(p.start_date)).select("date").distinct().collect())
    late = days[len(days) // 2]
    early = with_source(whole, workload_costs=whole.workload_costs.where(
        (F.col("date") != F.lit(late)) | (F.pmod("workload_id", F.lit(2)) == 0)))
    first = refresh.refresh(spark, early, p, base, NAMES)
    assert all(len(first[n]) > 5 for n in NAMES)
    before = refresh.manifest(spark, base)
    second = refresh.refresh(spark, whole, p, base, NAMES)
    assert second == {"account_risk": [late.isoformat()], "risk_rollup_workspace": [late.isoformat()],
                      "cluster_idle_with_config": [late.isoformat()], "warehouse_daily": [], "run_worker_profile": []}
    after = refresh.manifest(spark, base)
    for n in NAMES:  # other dates keep their folders
        kept = {d: x["path"] for d, x in after["datasets"][n]["days"].items() if d not in second[n]}
        assert kept == {d: before["datasets"][n]["days"][d]["path"] for d in kept}
    pl = Pipeline(whole, p)
    for n in NAMES:
        out, want = refresh.published(spark, base, n), getattr(pl, n)
        assert out.dtypes == want.dtypes and rows(out) == rows(want), n
    assert refresh.refresh(spark, whole, p, base, NAMES) == {n: [] for n in NAMES}
    assert refresh.manifest(spark, base)["number"] == 2  # nothing new, nothing published


def test_killed_before_the_switch_leaves_the_old_state(spark, whole, monkeypatch):
    base, p = place(), fixture_params()
    some = with_source(whole, warehouse_metrics=whole.warehouse_metrics.where("active_tasks > 2"))
    refresh.refresh(spark, some, p, base, ("warehouse_daily",))
    old = rows(refresh.published(spark, base, "warehouse_daily"))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(refresh, "_publish", killed)
        with pytest.raises(KeyboardInterrupt):
            refresh.refresh(spark, whole, p, base, ("warehouse_daily",))
    assert rows(refresh.published(spark, base, "warehouse_daily")) == old
    assert refresh.refresh(spark, whole, p, base, ("warehouse_daily",))["warehouse_daily"]
    assert rows(refresh.published(spark, base, "warehouse_daily")) == rows(Pipeline(whole, p).warehouse_daily) != old
    # the killed run's folder goes, those of the last two states stay
    assert len(refresh.expire(spark, base, keep=2)) == 1 and refresh.expire(spark, base, keep=2) == []
    refresh.expire(spark, base, keep=1)
    assert rows(refresh.published(spark, base, "warehouse_daily")) == rows(Pipeline(whole, p).warehouse_daily)


def test_two_runs_cannot_both_publish(spark, whole):
    base, p = place(), fixture_params()
    refresh.refresh(spark, whole, p, base, ("warehouse_daily",))
    state = refresh.manifest(spark, base)
    with pytest.raises(refresh.Conflict):
        refresh._publish(spark, base, state)
    assert refresh.manifest(spark, base) == state and not [
        n for n in refresh._children(spark, f"{base}/_manifests") if n.endswith(".tmp")]


def test_undated_sources_and_parameters_touch_every_date(spark, whole):
    base, p = place(), fixture_params()
    n = ("warehouse_daily",)
    days = refresh.refresh(spark, whole, p, base, n)["warehouse_daily"]
    less = with_source(whole, workspaces=whole.workspaces.where("workspace_id % 3 > 0"))
    assert refresh.refresh(spark, less, p, base, n)["warehouse_daily"] == days
    assert rows(refresh.published(spark, base, n[0])) == rows(Pipeline(less, p).warehouse_daily)
    later = fixture_params(start_date=p.start_date + dt.timedelta(days=3))
    assert len(refresh.refresh(spark, less, later, base, n)["warehouse_daily"]) == len(days) - 3
    assert rows(refresh.published(spark, base, n[0])) == rows(Pipeline(less, later).warehouse_daily)


def test_lost_and_empty_dates(spark, whole):
    base, p = place(), fixture_params()
    n = ("warehouse_daily",)
    days = refresh.refresh(spark, whole, p, base, n)["warehouse_daily"]
    gone = with_source(whole, warehouse_metrics=whole.warehouse_metrics.where(F.col("date") != F.lit(days[2]).cast("date")))
    assert refresh.refresh(spark, gone, p, base, n)["warehouse_daily"] == []
    assert days[2] not in refresh.manifest(spark, base)["datasets"]["warehouse_daily"]["days"]
    assert rows(refresh.published(spark, base, n[0])) == rows(Pipeline(gone, p).warehouse_daily)
    none = with_source(whole, warehouse_metrics=whole.warehouse_metrics.where("false"))
    refresh.refresh(spark, none, p, base, n)
    out = refresh.published(spark, base, n[0])
    assert out.count() == 0 and out.dtypes == Pipeline(whole, p).warehouse_daily.dtypes


def test_order_of_rows_is_no_change(spark, whole):
    p = fixture_params()
    mixed = with_source(whole, job_runs=whole.job_runs.repartition(7).sortWithinPartitions(F.rand(3)))
    assert refresh.fingerprints(whole, p, ["job_runs"]) == refresh.fingerprints(mixed, p, ["job_runs"])


def test_any_date_profiles_depend_on_all_samples(whole):
    prints = {"node_timeline": {"2024-01-02": "1:1"}, "job_runs": {"2024-01-02": "1:1", "2024-01-03": "1:1"}}
    more = {**prints, "node_timeline": {"2024-01-02": "2:2"}}
    used = tuple(prints)

    def touched(p):
        a, b = refresh._wanted(prints, used, p), refresh._wanted(more, used, p)
        return [d for d in a if a[d] != b[d]]

    assert touched(Params("2024-01-01")) == ["2024-01-02"]
    assert touched(Params("2024-01-01", same_date=False)) == ["2024-01-02", "2024-01-03"]


def test_unknown_names(spark, whole):
    with pytest.raises(ValueError):
        refresh.refresh(spark, whole, fixture_params(), place(), ("workload_usage_daily",))
    with pytest.raises(ValueError):
        refresh.published(spark, place(), "account_risk")
    with pytest.raises(ValueError):
        refresh.expire(spark, place(), keep=0)

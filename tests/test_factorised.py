"""Risk rollups from uncopied rows, merged parts, and unit totals without a window."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from costlens.operators import rollups
from costlens.plans.runner import run_pipeline
from costlens.sources import Sources
from costlens.sources.testdata import fixture_params

SF = "/root/testdata/sf0.001"
MERGED = {"risk_rollup_account": "merged_rollup_account", "risk_rollup_workspace": "merged_rollup_workspace",
          "risk_rollup_job": "merged_rollup_job"}


@pytest.fixture(scope="module")
def pl(spark):
    return E.pipeline(spark, SF, fresh=True)


def same(a, b):
    def rows(df):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)

    assert a.dtypes == b.select(*a.columns).dtypes
    assert rows(a) == rows(b.select(*a.columns))


def test_rows_are_not_copied_but_weighed(pl):
    lines = pl._rollup_rows
    literal = pl.run_risk.count()
    assert lines.count() * 2 < literal == lines.agg(F.sum("copies")).first()[0]
    copies = {tuple(r)[:5]: r.copies for r in pl.run_line_copies.collect()}
    keys = ["date", "workspace_id", "cluster_id", "job_id", "run_id"]
    assert copies == {tuple(r)[:5]: r["count"] for r in pl.run_worker_profile.groupBy(*keys).count().collect()}
    assert any(n > 1 for n in copies.values())


def test_plans_have_no_fanned_out_row(pl):
    for key in (*MERGED, *MERGED.values(), "risk_rollup_levels"):
        plan = getattr(pl, key)._jdf.queryExecution().optimizedPlan().toString()
        # the lines are only counted: no row carries their columns into the run join
        joined = [x for x in plan.splitlines() if "Join" in x]
        assert joined and not any("usage_origin" in x or "auto_termination" in x for x in joined), key
        projected = [x for x in plan.splitlines() if "Project" in x and "run_id" in x]
        assert projected and not any("usage_origin" in x or "auto_termination" in x for x in projected), key


def test_merged_parts_equal_own_passes(pl):
    for key, merged in MERGED.items():
        same(getattr(pl, key), getattr(pl, merged))
        level = pl.risk_rollup_levels.where(F.col("level") == key.rsplit("_", 1)[1])
        same(getattr(pl, key), level)


def test_runs_of_many_blocks_and_jobs_count_once(spark):
    """One run id under several jobs, ids far apart, and nulls."""
    rnd = random.Random(3)
    rows, runs = [], [rnd.randrange(1 << 40) for _ in range(300)] + list(range(32760, 32775)) + [0]
    for _ in range(2000):
        r = rnd.choice(runs)
        rows.append((rnd.randint(0, 1), rnd.randint(0, 2), rnd.randint(0, 5), r, rnd.randint(1, 3)))
    rows += [(0, 0, 0, None, 1)] * 3
    df = spark.createDataFrame(rows, "account_id long, workspace_id long, job_id long, run_id long, copies long")
    rest = [k for k in rollups.JOB_DAY_KEYS if k not in df.columns]
    df = df.select("*", *[F.lit("x").alias(k) for k in rest], F.col("run_id").alias("run_no"),
                   *[F.lit(3).cast("long").alias(f"sum_{d}_network_{w}_bytes") for d in "dw" for w in ("sent", "received")],
                   F.lit(7).cast("long").alias("duration_seconds"), F.lit("1.25").cast("decimal(18,4)").alias("attributed_revenue"),
                   *[F.lit(x).alias(n) for n, x in (("rev_at_risk", 0.5), ("rev_at_risk_utilization", 0.25), ("rev_at_risk_all_purpose", 0.125))],
                   F.when(F.col("job_id") > 2, F.col("job_id") + 0.5).alias("avg_cluster_cpu_utilization"),
                   F.lit(None).cast("double").alias("avg_cluster_mem_used_percent"))
    parts = rollups.risk_parts(df)
    by_workspace = rollups.merged_parts(parts, rollups.WORKSPACE_DAY_KEYS)
    for own, keys in ((parts, rollups.JOB_DAY_KEYS), (by_workspace, rollups.WORKSPACE_DAY_KEYS),
                      (rollups.merged_parts(by_workspace, rollups.ACCOUNT_DAY_KEYS), rollups.ACCOUNT_DAY_KEYS)):
        got = rollups.parts_rollup(own, keys)
        same(rollups.risk_rollup(df, keys), got)
        copied = df.select("*", F.explode(F.sequence(F.lit(1), "copies")))
        literal = copied.groupBy(*keys).agg(F.sum("duration_seconds"), F.count_distinct("run_id"), F.sum("attributed_revenue"),
                                            F.avg("avg_cluster_cpu_utilization"), F.avg("avg_cluster_mem_used_percent"))
        want = sorted((tuple(r)[len(keys):] for r in literal.collect()), key=str)
        mine = got.select("total_duration_seconds", "job_run_count", "revenue", "avg_cluster_cpu_utilization", "avg_cluster_mem_used_percent")
        assert [tuple(round(x, 9) if isinstance(x, float) else x for x in t) for t in want] == sorted(
            (tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in mine.collect()), key=str)


def test_run_numbers_are_one_per_id_and_dense(pl):
    numbers = {r.run_id: r.run_no for r in pl.run_numbers.collect()}
    ids = {r[0] for r in pl.runs_scoped.select("run_id").distinct().collect()}
    assert set(numbers) == ids and len(set(numbers.values())) == len(ids)
    blocks = {n >> 33 for n in numbers.values()}
    for b in blocks:  # within a partition there are no gaps
        own = sorted(n & ((1 << 33) - 1) for n in numbers.values() if n >> 33 == b)
        assert own == list(range(len(own)))


def test_runner_reads_the_cost_lines_once_for_all_rollups(spark, pl):
    base = tempfile.mkdtemp(prefix="costlens-parts-")
    names = ("run_profile", "risk_job_parts", "risk_workspace_parts", *MERGED)
    out = run_pipeline(spark, Sources.from_test_tables(spark, SF), fixture_params(), base, only=names)
    assert set(out) == set(names)
    for key in MERGED:
        same(getattr(pl, key), spark.read.parquet(out[key]))
    fresh = E.pipeline(spark, SF, fresh=True)
    fresh.__dict__["risk_job_parts"] = spark.read.parquet(out["risk_job_parts"])
    fresh.__dict__["risk_workspace_parts"] = spark.read.parquet(out["risk_workspace_parts"])
    for key in MERGED.values():
        files = getattr(fresh, key).inputFiles()
        assert files and all("_parts/" in f for f in files), key


def days(spark, n):
    """Account rows, nearly all of one date and unit."""
    rnd = random.Random(n)
    rows = []
    for i in range(n):
        unit = "hot" if i % 50 else rnd.choice(["cold", None])
        rows.append(("2024-01-02" if i % 90 else None, f"a{i}", unit, rnd.choice([None, 5]), rnd.randint(0, 3)))
    df = spark.createDataFrame(rows, "date string, account_name string, bu_1 string, dat_acnt long, n_sql long")
    rest = [d for d in rollups.ACCOUNT_DIMS if d not in df.columns]
    money = [*rollups.COST_TOTALS.values(), "sql_dollars"]
    return df.select(F.col("date").cast("date").alias("date"), *[c for c in df.columns if c != "date"],
                     *[F.lit("x").alias(d) for d in rest], F.col("dat_acnt").alias("dts_acnt"),
                     *[F.lit("2.50").cast("decimal(38,2)").alias(c) for c in money])


def test_unit_totals_of_a_hot_unit(spark, pl):
    for key in ("warehouse_util_by_account", "account_cost_and_util", "account_risk"):
        assert "Window" not in getattr(pl, key)._jdf.queryExecution().executedPlan().toString(), key
    df = days(spark, 20_000).repartition(8)
    totals = {}
    for r in df.collect():
        if r.date and r.bu_1 and r.n_sql > 0:
            totals.setdefault((r.date, r.bu_1), []).append(r.dat_acnt)
    totals = {k: sum(x for x in v if x is not None) if any(x is not None for x in v) else None for k, v in totals.items()}
    out = rollups.with_unit_totals(df)
    got = out.collect()
    assert len(got) == 20_000
    assert all(r.dat_bu1 == totals.get((r.date, r.bu_1)) for r in got)
    # nearly all rows are of one unit, and no task holds them all
    at = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in at) < 0.5 * len(got)

"""Edge fixtures for the column rules (FIXTURES.md §3), expected values by hand."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costlens.functions import rules
from costlens.params import Params


def rows(spark, schema, data):
    return spark.createDataFrame(data, schema)


def test_normalized_status(spark):
    df = rows(
        spark,
        "t string, c string, p string",
        [("RUNNING", "ERROR", None), ("RUNNING", None, "X"), ("Failed", "FINISHED", None),
         (None, "Skipped", None), (None, None, "COMPLETED"), (None, None, None)],
    )
    got = [r.s for r in df.select(rules.normalized_status(F.col("t"), F.col("c"), F.col("p")).alias("s")).collect()]
    assert got == ["error", None, "failed", "skipped", "completed", None]


def test_failure_flag_and_halves(spark, params):
    df = rows(spark, "s string, rev decimal(18,4)",
              [("failed", Decimal("10.01")), ("succeeded", Decimal("10.0140")), (None, Decimal("3"))])
    out = df.select(
        rules.job_status(F.col("s"), params).alias("st"),
        rules.failed_revenue_half(F.col("s"), F.col("rev"), params).alias("half"),
        rules.revenue_after_failures(F.col("s"), F.col("rev"), params).alias("after"),
    ).collect()
    assert [r.st for r in out] == ["failed", "success", "success"]
    assert [r.half for r in out] == [Decimal("5.01"), Decimal("0.00"), Decimal("0.00")]
    assert [r.after for r in out] == [Decimal("5.01"), Decimal("10.01"), Decimal("3.00")]


def test_idle_revenue(spark):
    df = rows(spark, "p string, sku string, w string, rev decimal(18,4)", [
        ("ALL_PURPOSE", "PREMIUM_ALL_PURPOSE_COMPUTE", "idleWorkloads", Decimal("100")),
        ("ALL_PURPOSE", "PREMIUM_ALL_PURPOSE_SERVERLESS_COMPUTE", "idleWorkloads", Decimal("100")),
        ("ALL_PURPOSE", None, "idleWorkloads", Decimal("100")),
    ])
    got = [r.x for r in df.select(rules.idle_revenue(F.col("p"), F.col("sku"), F.col("w"), F.col("rev")).alias("x")).collect()]
    assert got == [Decimal("100.00"), 0, 0]


def test_tiers(spark, params):
    data = [
        ("ALL_PURPOSE", "ENTERPRISE_ALL_PURPOSE_COMPUTE", "jobRuns"),
        ("ALL_PURPOSE", "STANDARD_ALL_PURPOSE_COMPUTE", "jobRuns"),
        ("ALL_PURPOSE", "PREMIUM_ALL_PURPOSE_COMPUTE", "jobRuns"),
        ("ALL_PURPOSE", "OTHER_ALL_PURPOSE_COMPUTE", "jobRuns"),
        ("ALL_PURPOSE", "PREMIUM_ALL_PURPOSE_SERVERLESS_COMPUTE", "jobRuns"),
        ("JOBS", "PREMIUM_JOBS_COMPUTE", "jobRuns"),
    ]
    df = rows(spark, "p string, sku string, w string", data).withColumn("rev", F.lit(Decimal("100")).cast("decimal(18,4)"))
    c = [F.col("p"), F.col("sku"), F.col("w"), F.col("rev"), params]
    out = df.select(rules.tiered_interactive_risk(*c).alias("r"), rules.tiered_corrected_revenue(*c).alias("k")).collect()
    assert [float(r.r) for r in out] == [70, 62.5, 45.5, 0, 0, 0]
    assert [float(r.k) for r in out] == [30, 37.5, 54.5, 100, 100, 100]


def test_flat_penalty(spark, params):
    df = rows(spark, "p string", [("JOBS",), ("ALL_PURPOSE",), ("SQL",), (None,)])
    out = df.select(
        rules.flat_penalty(F.col("p"), params).alias("a"),
        rules.flat_penalty(F.col("p"), params, null_product=True).alias("b"),
    ).collect()
    assert [r.a for r in out] == [0.0, 0.6, 0.6, 0.0]
    assert [r.b for r in out] == [0.0, 0.6, 0.6, None]


def _risk_row(spark, params, d_units, w_units, average=True):
    from costlens.plans.pipeline import add_run_risk, add_utilization, add_utilization_risk

    cols = {
        "driver_cost_units": float(d_units), "worker_cost_units": float(w_units),
        "avg_w_cpu_user_pct": 15.0, "avg_w_cpu_system_pct": 5.0,
        "avg_d_cpu_user_pct": 6.0, "avg_d_cpu_system_pct": 4.0,
        "avg_w_mem_used_pct": 40.0, "avg_d_mem_used_pct": 20.0,
        "avg_w_mem_swap_pct": 1.0, "avg_d_mem_swap_pct": 1.0,
        "avg_w_cpu_wait_pct": 1.0, "avg_d_cpu_wait_pct": 1.0,
    }
    df = spark.range(1).select(
        *[F.lit(v).alias(k) for k, v in cols.items()],
        F.lit(Decimal("120")).cast("decimal(18,4)").alias("attributed_revenue"),
        F.lit("ALL_PURPOSE").alias("product_type"),
        *[F.lit(None).cast("decimal(38,0)").alias(f"sum_{r}_network_{d}_bytes") for r in "dw" for d in ("received", "sent")],
    )
    return add_run_risk(add_utilization_risk(add_utilization(df), params, average), params).first()


def test_utilization_risk_chain(spark, params):
    r = _risk_row(spark, params, 1, 3)
    assert r.driver_cost_share == 0.25 and r.worker_cost_share == 0.75
    assert r.avg_cluster_cpu_utilization == pytest.approx(17.5)
    assert r.avg_cluster_mem_used_percent == pytest.approx(35.0)
    assert r.utilization_penalty == pytest.approx((12.5 / 30 + 15 / 50) / 2)
    assert r.rev_at_risk_utilization == pytest.approx(43.0)
    assert r.rev_at_risk_all_purpose == pytest.approx(0.6 * 77)
    assert r.rev_at_risk == pytest.approx(89.2)
    # E20 = E18 + E19
    assert r.rev_at_risk == pytest.approx(r.rev_at_risk_utilization + r.rev_at_risk_all_purpose, abs=1e-9)
    assert _risk_row(spark, params, 1, 3, average=False).utilization_penalty == pytest.approx(0.7166666666)


def test_zero_units_do_not_raise(spark, params):
    r = _risk_row(spark, params, 0, 0)
    assert r.driver_cost_share is None and r.avg_cluster_cpu_utilization is None
    assert r.utilization_penalty == 0 and r.rev_at_risk_utilization == 0
    assert r.rev_at_risk_all_purpose == pytest.approx(72) and r.rev_at_risk == pytest.approx(72)
    assert r.has_full_profile is True


def test_penalty_bounds(spark, params):
    df = rows(spark, "cpu double, mem double", [(45.0, 80.0), (None, None), (0.0, 0.0)])
    got = [r.u for r in df.select(rules.utilization_penalty(F.col("cpu"), F.col("mem"), params).alias("u")).collect()]
    assert got == [0.0, 0.0, 1.0]


def test_gap_rules(spark):
    df = rows(spark, "u double, a double, d double",
              [(0.8, 0.5, 100.0), (0.5, 0.8, 100.0), (0.8, None, 100.0), (0.0, 0.0, 100.0)])
    u, a, d = F.col("u"), F.col("a"), F.col("d")
    out = df.select(rules.gap_pct(u, a).alias("g"), rules.gap_dollars(u, a, d).alias("x"),
                    rules.gap_dollars_revised(u, a, d).alias("y")).collect()
    assert out[0].g == pytest.approx(0.375) and out[0].x == pytest.approx(37.5) and out[0].y == pytest.approx(30)
    assert [r.g for r in out[1:]] == [0.0, 0.0, 0.0]


def test_total_risk(spark):
    df = spark.range(1).select(F.lit(10.0).alias("i"), F.lit(5.0).alias("idle"), F.lit(30.0).alias("g"),
                               F.lit(2.0).alias("f"), F.lit(200.0).alias("c"))
    r = df.select(rules.total_risk(F.col("i"), F.col("idle"), F.col("g"), F.col("f")).alias("r"),
                  rules.adjusted_usage(F.col("c"), F.col("idle"), F.col("g"), F.col("f")).alias("a")).first()
    assert r.r == 47 and r.a == 163


def test_params_reject_bad_date():
    with pytest.raises(ValueError):
        Params(start_date="nope")
    p = Params(start_date="2024-01-05", excluded_names=(" A ",))
    assert p.change_date == p.start_date and p.excluded_names == ("a",)

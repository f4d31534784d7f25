"""Run windows over many days (X15 off): dyadic blocks instead of a row per bucket."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from costlens.operators import intervals
from costlens.params import Params

START = dt.datetime(2024, 1, 1)
KEYS = ("min_d_cpu_user_pct", "max_d_cpu_user_pct", "avg_d_cpu_user_pct", "sum_d_network_sent_bytes")


def windows(spark, spans):
    """spans: (first minute, last minute) after START."""
    rows = [
        (START.date(), 1, 10, START + dt.timedelta(minutes=a), START + dt.timedelta(minutes=b)) for a, b in spans
    ]
    return spark.createDataFrame(
        rows, "date date, workspace_id long, cluster_id long, run_start_floor timestamp, run_term_ceil timestamp")


def samples(spark, n, every=7):
    """A sample each few minutes; some last for hours and cross many buckets."""
    start = F.timestamp_add("SECOND", F.col("id") * 60 * every + F.pmod(F.col("id") * 17, F.lit(60)), F.lit(START))
    length = F.when(F.col("id") % 40 == 0, 60 * 60 * 5).otherwise(60).cast("int")
    out = spark.range(n).select(
        F.to_date(start).alias("date"),
        F.lit(1).cast("long").alias("workspace_id"),
        F.lit(10).cast("long").alias("cluster_id"),
        F.lit(True).alias("driver"),
        start.alias("start_time"),
        F.timestamp_add("SECOND", length, start).alias("end_time"),
        *[((F.col("id") * (i + 3)) % 101).cast("double").alias(m) for i, (_, m) in enumerate(intervals.METRICS)],
        *[(F.col("id") % 977).cast("long").alias(b) for _, b in intervals.BYTES],
    )
    return out


def literal(runs, data):
    inside = (F.col("start_time") >= F.col("run_start_floor")) & (F.col("end_time") <= F.col("run_term_ceil"))
    return runs.join(data.drop("date"), ["workspace_id", "cluster_id"]).where(inside).groupBy(
        *intervals.WINDOW_KEY
    ).agg(
        F.min("cpu_user_pct").alias(KEYS[0]),
        F.max("cpu_user_pct").alias(KEYS[1]),
        F.avg("cpu_user_pct").alias(KEYS[2]),
        F.sum("network_sent_bytes").alias(KEYS[3]),
    )


SPANS = [(0, 30 * 1440), (1, 30 * 1440 - 1), (61, 119), (60, 120), (60, 60), (59, 61), (60, 180), (30, 17 * 1440 + 13),
         (1440, 2880), (7 * 60, 9 * 60), (5 * 60 + 1, 29 * 1440), (3, 4), (200, 100), (1023 * 60, 1025 * 60)]


@pytest.mark.parametrize("top", [12, 3, 0])
@pytest.mark.parametrize("width", [3600, 900])
def test_equals_the_literal_join(spark, monkeypatch, top, width):
    monkeypatch.setattr(intervals, "MAX_LEVEL", top)
    runs, data = windows(spark, SPANS), samples(spark, 6000)
    p = Params("2024-01-01", same_date=False, bucket_seconds=width)
    got = intervals.window_profile(runs, data, p, ("driver",)).select(*intervals.WINDOW_KEY, *KEYS)
    rows = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())
    want = rows(literal(runs, data))
    assert rows(got) == want and len(want) > 8


def test_a_window_meets_two_blocks_per_level(spark):
    p = Params("2024-01-01", same_date=False)
    for days in (1, 7, 30, 90):
        spans = [(a, a + days * 1440) for a in range(0, 20_000, 613)]
        blocks = intervals._window_blocks(windows(spark, spans), p)
        whole = blocks.where(F.col("_level") == intervals._WHOLE).groupBy("run_start_floor").count()
        assert whole.agg(F.max("count")).first()[0] <= 2 * math.log2(days * 24)
        edges = blocks.where(F.col("_level") == intervals._EDGE).groupBy("run_start_floor").count()
        assert edges.agg(F.max("count")).first()[0] <= 2


def test_blocks_cover_the_inside_once(spark):
    p = Params("2024-01-01", same_date=False)
    blocks = intervals._window_blocks(windows(spark, SPANS), p).where(F.col("_level") == intervals._WHOLE)
    width = F.pow(F.lit(2), F.col("_j")).cast("long")
    bucket = F.explode(F.sequence(F.col("_block") * width, (F.col("_block") + 1) * width - 1)).alias("b")
    got = {tuple(r) for r in blocks.select("run_start_floor", "run_term_ceil", bucket).collect()}
    n = blocks.select("run_start_floor", "run_term_ceil", bucket).count()
    want = set()
    for a, b in SPANS:
        lo, hi = START + dt.timedelta(minutes=a), START + dt.timedelta(minutes=b)
        hour = START - dt.timedelta(hours=1)
        while hour < hi:
            if hour >= lo and hour + dt.timedelta(hours=1) <= hi:
                since = (hour - dt.datetime(1970, 1, 1)).total_seconds()
                want.add((lo, hi, int(since // 3600)))
            hour += dt.timedelta(hours=1)
    assert got == want and n == len(want)

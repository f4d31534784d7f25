"""Averages of doubles: the same bytes for any order and partitioning of the rows."""

import math
import random
import struct
from fractions import Fraction
from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from costlens.functions.exact import exact_parts, exact_total, part_names
from costlens.operators import intervals, rollups

SF = "/root/testdata/sf0.001"
PARTITIONS = (1, 7, 200)


def bits(v):
    return struct.pack("<d", v) if isinstance(v, float) else v


def values(seed, n=4000):
    rnd = random.Random(seed)
    kinds = (lambda: rnd.uniform(0, 100), lambda: rnd.uniform(-50, 50), lambda: rnd.uniform(0, 2**29),
             lambda: rnd.uniform(0, 1e-6), lambda: None, lambda: 0.1, lambda: -0.0)
    return [(rnd.randrange(5), rnd.choice(kinds)(), rnd.randint(1, 4)) for _ in range(n)]


def summed(df):
    parts = df.groupBy("k").agg(*exact_parts(F.col("x"), "s", F.col("w")))
    return {r.k: r.t for r in parts.select("k", exact_total("s").alias("t")).collect()}


def on_grid(x):
    return Fraction(x) if abs(x) >= 2**-8 or x == 0 else Fraction(round(Fraction(x) * 2**60), 2**60)


def test_sum_is_exact_and_does_not_depend_on_order(spark):
    rows = values(1)
    seen = set()
    for n in PARTITIONS:
        random.Random(n).shuffle(rows)
        got = summed(spark.createDataFrame(rows, "k int, x double, w int").repartition(n))
        seen.add(tuple(sorted((k, bits(t)) for k, t in got.items())))
    assert len(seen) == 1
    for k, t in got.items():
        want = sum(on_grid(x) * w for key, x, w in rows if key == k and x is not None)
        assert t == pytest.approx(float(want), rel=2**-52)
    # a plain sum of the same doubles does depend on it
    mine = [x * w for key, x, w in rows if key == 0 and x is not None]
    assert len({reduce(add, random.Random(i).sample(mine, len(mine))) for i in range(20)}) > 1


def test_parts_merge_like_sums(spark):
    df = spark.createDataFrame(values(2), "k int, x double, w int")
    fine = df.groupBy("k", "w").agg(*exact_parts(F.col("x"), "s", F.col("w")))
    merged = fine.groupBy("k").agg(*[F.sum(n).alias(n) for n in part_names("s")])
    assert {r.k: bits(r.t) for r in merged.select("k", exact_total("s").alias("t")).collect()} == {
        k: bits(t) for k, t in summed(df).items()
    }


def test_nulls_large_values_and_no_rows(spark):
    rows = [(0, None, 1), (1, 1e300, 2), (1, 1.5, 1), (2, float("inf"), 1), (2, 3.0, 1), (3, float("nan"), 1),
            (3, 2.0, 1), (4, -0.75, 2), (4, None, 1), (5, 2.0**30, 1), (5, -(2.0**30), 1), (5, 0.25, 1)]
    got = summed(spark.createDataFrame(rows, "k int, x double, w int"))
    assert (got[0], got[1], got[2], got[4], got[5]) == (None, 2e300, math.inf, -1.5, 0.25)
    assert math.isnan(got[3])
    empty = spark.createDataFrame([], "k int, x double, w int")
    assert summed(empty) == {}
    assert empty.agg(*exact_parts(F.col("x"), "s")).select(exact_total("s")).first()[0] is None


def fingerprint(df):
    return sorted((tuple(bits(v) for v in r) for r in df.collect()), key=str)


def thirds(df, names):
    """Values that no double holds exactly, so that plain sums would differ."""
    return df.select(*[(F.col(c) / 3.0 + 0.1).alias(c) if c in names else F.col(c) for c in df.columns])


def test_run_profile_has_the_same_bytes_for_any_partitioning(spark):
    pl = E.pipeline(spark, SF, fresh=True)
    samples = thirds(pl.timeline, {dst for _, dst in intervals.METRICS})
    seen = {
        str(fingerprint(intervals.run_profile(pl.runs_scoped.distinct(), samples.repartition(n, F.rand(n)), pl.p)))
        for n in PARTITIONS
    }
    assert len(seen) == 1


def test_rollups_have_the_same_bytes_for_any_partitioning(spark):
    pl = E.pipeline(spark, SF, fresh=True)
    rows = thirds(pl._rollup_rows, set(rollups._RISK_MEANS[:2]))
    seen = {
        str(fingerprint(rollups.risk_rollup(rows.repartition(n, F.rand(n)), rollups.ACCOUNT_DAY_KEYS)))
        for n in PARTITIONS
    }
    assert len(seen) == 1

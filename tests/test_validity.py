"""Dated lines as validity intervals and their lookup."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from costlens.operators import validity
from costlens.plans import Pipeline
from costlens.plans.runner import run_pipeline
from costlens.sources import Sources
from costlens.sources.testdata import fixture_params

SF = "/root/testdata/sf0.001"
SCHEMA = "date date, ws long, dim string, extra long"
DAY = dt.date(2024, 1, 1)
KEY = ["ws"]


def day(n):
    return DAY + dt.timedelta(days=n)


def literal_periods(rows):
    """Days walked one by one: the state of a key and the periods of its changes."""
    state = {}
    for d, ws, *line in set(rows):
        if d is not None:
            state.setdefault(ws, {}).setdefault(d, set()).add(tuple(line))
    out = []
    for ws, days in state.items():
        for d in sorted(days):
            if days.get(d - dt.timedelta(days=1)) == days[d]:
                continue
            end = d
            while days.get(end + dt.timedelta(days=1)) == days[d]:
                end += dt.timedelta(days=1)
            out += [(ws, *line, d, end) for line in days[d]]
    return sorted(out, key=str)


def random_rows(seed):
    rnd = random.Random(seed)
    rows = []
    for ws in (1, 2, 3, None):
        for line in range(3):
            value = rnd.choice([None, "a", "b"])
            for n in range(25):
                if rnd.random() < 0.1:
                    value = rnd.choice([None, "a", "b"])
                if rnd.random() < 0.9:
                    rows.append((day(n), ws, value, rnd.choice([line, line, None]) if rnd.random() < 0.1 else line))
    return rows + rows[:20] + [(None, 1, "a", 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_periods_and_back(spark, seed):
    rows = random_rows(seed)
    daily = spark.createDataFrame(rows, SCHEMA)
    table = validity.periods(daily, KEY)
    assert sorted((tuple(r) for r in table.collect()), key=str) == literal_periods(rows)
    back = validity.lines(table).select(*daily.columns)
    want = {r for r in rows if r[0] is not None}
    got = [tuple(r) for r in back.collect()]
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("seed", [4, 5])
def test_lookup_equals_join_by_day(spark, seed):
    rows = random_rows(seed)
    daily = spark.createDataFrame(rows, SCHEMA)
    rnd = random.Random(seed)
    facts = [(rnd.choice([1, 2, 3, 4, None]), rnd.choice([None, *map(day, range(-3, 30))]), i) for i in range(300)]
    facts = spark.createDataFrame(facts, "ws long, date date, fact long")
    met = validity.in_force(facts, validity.periods(daily, KEY), KEY)
    a = sorted((tuple(r) for r in facts.join(met, ["ws", "date"]).collect()), key=str)
    b = sorted((tuple(r) for r in facts.join(daily.distinct(), ["ws", "date"]).collect()), key=str)
    assert a == b and a


def test_steady_lines_shrink_to_one_row(spark):
    daily = spark.range(400).selectExpr("date_add(date'2024-01-01', cast(id as int)) as date", "1L as ws", "'x' as dim")
    assert [tuple(r) for r in validity.periods(daily, KEY).collect()] == [(1, "x", DAY, day(399))]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    table = validity.periods(empty, KEY)
    assert table.count() == 0 and validity.lines(table).count() == 0
    assert validity.in_force(empty, table, KEY).count() == 0


def test_no_range_join_in_the_plan(spark):
    df = E.pipeline(spark, SF, mapping_periods=True).account_cost_core
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_runner_stores_the_changes(spark, tmp_path):
    src = Sources.from_test_tables(spark, SF)
    p = fixture_params(mapping_periods=True)
    names = ("mapping_periods", "mapping_scoped", "account_cost_core")
    out = run_pipeline(spark, src, p, str(tmp_path), only=names)
    assert set(out) == set(names)
    plain = Pipeline(src, fixture_params())
    for name in names[1:]:
        want = getattr(plain, name)
        got = spark.read.parquet(out[name]).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
    days = F.sum(F.date_diff("valid_to", "valid_from") + 1)
    stored = spark.read.parquet(out["mapping_periods"])
    assert stored.agg(days).first()[0] == plain.mapping.count() >= stored.count()
    assert "mapping_periods" not in run_pipeline(spark, src, fixture_params(), str(tmp_path), only=names)

"""D1-D4 with a scope that is not broadcast: a Bloom filter ahead of the exchange."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from costlens.operators import scope
from costlens.session import CLUSTER_CONF

SF = "/root/testdata/sf0.001"
PREFIX = "spark.sql.optimizer.runtime.bloomFilter."


@pytest.fixture
def cluster(spark):
    """The cluster's join settings; small tables count as large ones."""
    wanted = {k: v for k, v in CLUSTER_CONF.items() if k.startswith(PREFIX) or k.endswith("utoBroadcastJoinThreshold")}
    wanted |= {PREFIX + "applicationSideScanSizeThreshold": "0", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def nodes(plan):
    yield plan
    if plan.nodeName() == "AdaptiveSparkPlan":
        yield from nodes(plan.finalPhysicalPlan())
    elif "QueryStage" in plan.nodeName():
        yield from nodes(plan.plan())
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def rows_past_the_filter(df):
    """Rows that the Bloom filter let through, as Spark counted them."""
    df.collect()
    for n in nodes(df._jdf.queryExecution().executedPlan()):
        if n.nodeName() == "Filter" and "might_contain" in n.toString().split("\n")[0]:
            return n.metrics().apply("numOutputRows").value()
    return None


def test_foreign_rows_do_not_reach_the_exchange(spark, cluster, monkeypatch, tmp_path):
    monkeypatch.setattr(scope, "BROADCAST_ROWS", 10)
    ids = spark.range(0, 20_000).selectExpr("id * 10 as workspace_id", "id as crm_account_id", "id as account_id")
    ids.write.parquet(f"{tmp_path}/scope")
    spark.range(200_000).selectExpr("id as workspace_id", "id as value").write.parquet(f"{tmp_path}/facts")
    big = scope.bounded(spark.read.parquet(f"{tmp_path}/scope"))
    df = scope.runs_in_scope(spark.read.parquet(f"{tmp_path}/facts"), big)
    past = rows_past_the_filter(df)
    assert df.count() == 20_000
    assert past is not None and past - 20_000 < 0.05 * 180_000


def test_a_large_scope_keeps_its_rows(spark, monkeypatch):
    rows = [(5, 1, 1), (-3, 2, 2), (None, 3, 3)]
    stored = spark.createDataFrame(rows, "workspace_id long, crm_account_id long, account_id long")
    assert scope.bounded(stored).count() == 3
    monkeypatch.setattr(scope, "BROADCAST_ROWS", 1)
    assert sorted(r[0] for r in scope.bounded(stored).collect()) == [-3, 5]
    assert scope.bounded(stored.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["runs_scoped", "warehouse_scoped", "configs_scoped", "mapping_scoped", "timeline_scoped"])
def test_lazy_pipelines_filter_too(spark, cluster, name):
    df = getattr(E.pipeline(spark, SF, weight="none"), name)  # not the pipeline of other tests
    assert "might_contain" in df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_are_those_without_the_filter(spark, cluster):
    key = PREFIX + "enabled"
    found = []
    for on in ("true", "false"):
        spark.conf.set(key, on)
        df = getattr(E.pipeline(spark, SF, weight="none"), "runs_scoped").select("*", F.lit(1).alias("one"))
        found.append(sorted(map(str, df.collect())))
    spark.conf.set(key, "true")
    assert found[0] == found[1] and found[0]

"""Workspace scope (A13, B9-B12) and scope semi joins.

The scope is dimension-sized.  The runner stores it, counts it, and marks it for
broadcast up to ``BROADCAST_ROWS`` rows, so that no fact table is shuffled for it;
larger scopes, and scopes not stored, are joined as Spark's size rules decide, on a
cluster behind a runtime Bloom filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.params import Params


BROADCAST_ROWS = 1_000_000  # three keys a row


def bounded(stored: DataFrame) -> DataFrame:
    """A stored scope, marked for broadcast if it is counted small.

    A larger one is left to a shuffle join behind Spark's runtime Bloom filter
    (``session.CLUSTER_CONF``), which Spark makes only of a side that has a filter: the
    comparison with the smallest workspace keeps every row but those without one,
    which no join meets.
    """
    found = stored.agg(F.count("*").alias("n"), F.min("workspace_id").alias("least")).first()
    if found["n"] <= BROADCAST_ROWS:
        return F.broadcast(stored)
    return stored.where(F.col("workspace_id") >= F.lit(found["least"]))


def _eligible(workspaces: DataFrame, p: Params) -> DataFrame:
    w = workspaces.where(F.lower(F.trim("workspace_type")) == "external").where(
        F.col("crm_account_name").isNotNull() & F.col("crm_account_id").isNotNull()
    )
    if p.excluded_names:
        w = w.where(~F.lower(F.trim("crm_account_name")).isin(*p.excluded_names))
    return w.where(F.col("customer_id").isNotNull())


def _project(w: DataFrame) -> DataFrame:
    return w.select("workspace_id", F.col("customer_id").alias("crm_account_id"), "account_id")


def scope_workspaces(workspaces: DataFrame, excluded: DataFrame, p: Params) -> DataFrame:
    """External workspaces with a CRM account, minus excluded customers.

    Nulls are dropped from the exclusion list first, so one null there does not
    empty the scope (the literal ``NOT IN`` form is :func:`scope_not_in`).
    """
    ex = excluded.where(F.col("account_id").isNotNull()).select(F.col("account_id").alias("_ex"))
    w = _eligible(workspaces, p)
    return _project(w.join(ex, w["customer_id"] == ex["_ex"], "left_anti"))


def scope_not_in(workspaces: DataFrame, excluded: DataFrame, p: Params) -> DataFrame:
    """Literal ``customer_id NOT IN (SELECT account_id FROM excluded)``.

    A null in the list makes the test unknown for every row, so it empties the
    result; else the distinct keys are removed by a plain anti join.  (As one
    null-aware join Spark would broadcast the list whatever its size.)
    """
    ex = excluded.where(F.col("account_id").isNotNull()).select(F.col("account_id").alias("_ex"))
    has_null = excluded.agg(F.coalesce(F.bool_or(F.col("account_id").isNull()), F.lit(False)))
    w = _eligible(workspaces, p).where(~has_null.scalar())
    return _project(w.join(ex.distinct(), F.col("customer_id") == F.col("_ex"), "left_anti"))


def semi(df: DataFrame, scope: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys appear in ``scope`` (left semi join)."""
    return df.join(scope.select(*keys), list(keys), "left_semi")


def runs_in_scope(runs: DataFrame, scope: DataFrame) -> DataFrame:
    """D1."""
    return semi(runs, scope, ["workspace_id"])


def configs_in_scope(configs: DataFrame, scope: DataFrame) -> DataFrame:
    """D2."""
    return semi(configs, scope, ["workspace_id", "account_id"])


def mapping_in_scope(mapping: DataFrame, scope: DataFrame) -> DataFrame:
    """D3."""
    return semi(mapping, scope, ["workspace_id", "crm_account_id", "account_id"])


def warehouse_in_scope(metrics: DataFrame, scope: DataFrame) -> DataFrame:
    """D4."""
    return semi(metrics, scope, ["workspace_id"])

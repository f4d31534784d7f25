"""Materialize the pipeline's stored tables (K1) in dependency order.

Each stored dataset is written under ``base`` and read back before any
downstream dataset is planned, so later stages start from files instead of
re-running the upstream lineage — a lost executor only costs the tasks of
the stage in flight.  Give ``base``, a catalog ``database``, or set the session's
``spark.checkpoint.dir`` to a shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costlens.operators import scope
from costlens.params import Params
from costlens.plans.pipeline import Pipeline
from costlens.sinks import write_table
from costlens.sources import Sources

D = ("date",)
# (dataset, directory partitions, layout clustering keys) in dependency order.
STORED = (
    ("scope", (), ()),
    ("configs_scoped", (), ()),
    # Intermediate, if costs look the mapping up in its intervals.
    ("mapping_periods", (), ("workspace_id", "crm_account_id")),
    ("mapping_scoped", D, ("date", "workspace_id", "crm_account_id", "account_id")),
    ("workload_usage_daily", D, ()),
    # Intermediate: profiles before their fan-out, which the risk rollups start from.
    ("run_profile", D, ()),
    ("run_worker_profile", D, ("date", "workspace_id", "cluster_id", "job_id")),
    ("run_risk", D, ()),
    # Intermediate: the one pass over the cost lines that all three rollups merge.
    ("risk_job_parts", D, ()),
    ("risk_workspace_parts", D, ()),
    ("risk_rollup_account", D, ()),
    ("risk_rollup_job", D, ()),
    ("risk_rollup_workspace", D, ()),
    # Intermediate: the cost core feeds both the cost totals and the SQL
    # branch; writing it once avoids computing the cost-mapping join twice.
    ("account_cost_core", D, ()),
    ("account_risk", D, ()),
    ("cluster_idle_with_config", D, ()),
    ("warehouse_daily", D, ()),
    ("run_risk_combined", D, ()),
)

# Stored datasets that are planned over stored parts rather than in a pass of their own.
FROM_PARTS = {
    "risk_rollup_account": "merged_rollup_account",
    "risk_rollup_workspace": "merged_rollup_workspace",
    "risk_rollup_job": "merged_rollup_job",
}

# Filtered by any of its keys: rows laid out by the interleaved ranks of them.
LAYOUT = {"run_worker_profile": "z_order_by"}

# Stored only with the option of the same name.
OPTIONAL = ("mapping_periods",)

COMMENTS = {"account_risk": "Dollars at risk and in use, per account dimensions and day"}


def planned(pl: Pipeline, name: str) -> DataFrame:
    """The dataset as it is written: over stored parts where it has some."""
    if name == "mapping_scoped" and pl.p.mapping_periods:
        return pl.mapping_from_periods
    return getattr(pl, FROM_PARTS.get(name, name))


def run_pipeline(
    spark: SparkSession,
    sources: Sources,
    params: Params,
    base: str | None = None,
    only: tuple[str, ...] | None = None,
    database: str | None = None,
) -> dict[str, str]:
    """Write every stored dataset (or those in ``only``); return where each went.

    With ``database`` the datasets become catalog tables ``database.name``
    (with their comments, K3); otherwise parquet folders under ``base``.  With
    ``only``, datasets that are stored there already are read, not computed.
    """
    if database is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if base is None and shared is None:
            raise ValueError("give base or database, or set spark.checkpoint.dir")
        base = (base or f"{shared.rstrip('/')}/costlens").rstrip("/")
    pl = Pipeline(sources, params)
    out = {}
    for name, partition_by, cluster_by in STORED:
        loc = f"{base}/{name}" if database is None else f"{database}.{name}"
        if name in OPTIONAL and not getattr(params, name):
            continue
        if only is not None and name not in only:
            if not _is_stored(spark, loc, database):
                continue
        else:
            layout = {LAYOUT.get(name, "cluster_by"): cluster_by}
            place = {"path": loc} if database is None else {"table": loc, "comment": COMMENTS.get(name)}
            write_table(planned(pl, name), partition_by=partition_by, **place, **layout)
            out[name] = loc
        # Downstream datasets are planned over the stored table.
        stored = spark.read.parquet(loc) if database is None else spark.table(loc)
        pl.__dict__[name] = scope.bounded(stored) if name == "scope" else stored
    return out


def _is_stored(spark: SparkSession, loc: str, database: str | None) -> bool:
    if database is not None:
        return spark.catalog.tableExists(loc)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{loc}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def main(argv: list[str] | None = None) -> None:
    """``spark-submit --py-files costlens.zip costlens/plans/runner.py --sources sources.json ...``

    ``sources.json`` maps each logical source name to a path or catalog table.
    Dates default to the session conf keys ``costlens.start_date`` /
    ``costlens.change_date``; the output folder to ``spark.checkpoint.dir``.  The
    cluster settings of ``costlens.session`` apply where ``--conf`` gives none.
    """
    import argparse
    import json

    from costlens.session import apply_cluster_conf

    ap = argparse.ArgumentParser(prog="costlens.plans.runner")
    ap.add_argument("--sources", required=True, help="JSON file: logical source -> path or table")
    ap.add_argument("--start-date")
    ap.add_argument("--change-date")
    ap.add_argument("--excluded-name", action="append", default=[])
    ap.add_argument("--out", help="output folder (default: <spark.checkpoint.dir>/costlens)")
    ap.add_argument("--database", help="write catalog tables in this database instead of folders")
    ap.add_argument("--only", action="append", help="dataset to write (repeatable)")
    args = ap.parse_args(argv)

    spark = apply_cluster_conf(SparkSession.builder.getOrCreate())
    with open(args.sources) as fh:
        paths = json.load(fh)
    if args.start_date:
        params = Params(args.start_date, args.change_date, tuple(args.excluded_name))
    else:
        params = Params.from_conf(spark, excluded_names=tuple(args.excluded_name))
    out = run_pipeline(
        spark,
        Sources.from_paths(spark, paths),
        params,
        args.out,
        tuple(args.only) if args.only else None,
        args.database,
    )
    print(json.dumps(out))


if __name__ == "__main__":
    main()

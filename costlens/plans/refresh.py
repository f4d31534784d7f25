"""Refresh of stored tables by date, published in one switch (K1).

``refresh`` compares the sources with those of the last published state, date by
date, recomputes the dates that changed and publishes the new state of all
datasets together.  A *manifest* lists, per dataset and date, the folder with the
date's rows and the fingerprint of the source rows they were made from.  Folders
are written once and never changed; the manifest of a state is renamed into place
when all its folders are complete.  Readers take the last manifest, so they see the
old state or the new one whole, also when a run is killed half-way; two runs at a
time cannot both publish.

A fingerprint is the number of a date's rows in a source and the sum of their
hashes, so neither their order nor their files matter.  Sources without dates, and
the parameters, belong to every date: if they change, all dates do.  What is
collected is a row per source and date.

Only datasets whose rows of one date come from source rows of that date are
refreshed this way (``DATED``).  A date that lost all its rows in the sources is
dropped; one whose rows vanish in the joins stays listed, without a folder.

    base/_manifests/00000002.json     states, in order
    base/data/<run>/<dataset>/day=…   rows, each date by the run that made it
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlens.params import Params
from costlens.plans.pipeline import Pipeline
from costlens.sinks import write_table
from costlens.sources import SOURCE_NAMES, Sources

# The date of a source's rows, as its adapter takes it; the other sources have none.
SOURCE_DATES = {
    "usage_records": "usage_date",
    "node_timeline": "cast(start_time as date)",
    "job_runs": "date",
    "workload_costs": "date",
    "warehouse_metrics": "date",
    "account_mapping": "date",
}
_SCOPE = ("workspaces", "excluded_accounts")
_RUNS = ("job_runs", "node_timeline", *_SCOPE)
_LINES = (*_RUNS, "usage_records", "cluster_configs")
_COSTS = ("workload_costs", "account_mapping")
# dataset -> the sources it is made from
DATED = {
    "run_worker_profile": _LINES,
    "run_risk": (*_LINES, *_COSTS),
    "risk_rollup_account": (*_LINES, *_COSTS),
    "risk_rollup_job": (*_LINES, *_COSTS),
    "risk_rollup_workspace": (*_LINES, *_COSTS),
    "account_risk": (*_COSTS, "warehouse_metrics"),
    "cluster_idle_with_config": ("workload_costs", "cluster_configs", *_SCOPE),
    "warehouse_daily": ("warehouse_metrics", *_SCOPE),
    "run_risk_combined": (*_RUNS, "workload_costs"),
}


class Conflict(RuntimeError):
    """Another run published a state in the meantime."""


def source_date(name: str) -> Column:
    return F.expr(SOURCE_DATES[name])


def fingerprints(sources: Sources, params: Params, names: Iterable[str]) -> dict[str, dict[str, str]]:
    """source -> date (ISO; '' for sources without dates) -> fingerprint of its rows."""
    found: dict[str, dict[str, str]] = {n: {} for n in names}
    union = None
    for name in found:
        df = getattr(sources, name)
        day = source_date(name) if name in SOURCE_DATES else F.lit(None).cast("date")
        rows = df.select(
            F.lit(name).alias("source"),
            day.alias("day"),
            F.xxhash64(*df.columns).cast("decimal(20,0)").alias("h"),
        )
        if name in SOURCE_DATES:  # earlier rows, and those without a date, are not used
            rows = rows.where(F.col("day") >= F.lit(params.start_date))
        counts = rows.groupBy("source", "day").agg(F.count("*").alias("n"), F.sum("h").alias("h"))
        union = counts if union is None else union.unionByName(counts)
    for row in union.collect() if union is not None else ():
        found[row.source][row.day.isoformat() if row.day else ""] = f"{row.n}:{row.h}"
    return found


def _wanted(prints: dict[str, dict[str, str]], used: Iterable[str], params: Params) -> dict[str, str]:
    """date -> fingerprint of everything a dataset's rows of that date are made from."""
    undated = {n: prints[n].get("", "") for n in used if n not in SOURCE_DATES}
    if not params.same_date and "node_timeline" in used:  # samples of any date count
        undated["node_timeline"] = json.dumps(sorted(prints["node_timeline"].items()))
    common = json.dumps([repr(params), sorted(undated.items())])
    dated = [n for n in used if n in SOURCE_DATES]
    days = {d for n in dated for d in prints[n]}
    return {d: json.dumps([common, [(n, prints[n].get(d)) for n in sorted(dated)]]) for d in sorted(days)}


def _of_days(sources: Sources, days: list[str], params: Params) -> Sources:
    """The sources restricted to some dates, where they have dates."""

    def frame(name: str):
        df = getattr(sources, name)
        if name not in SOURCE_DATES or (name == "node_timeline" and not params.same_date):
            return df
        return df.where(source_date(name).isin(*[F.lit(d).cast("date") for d in days]))

    return Sources({n: (lambda n=n: frame(n)) for n in SOURCE_NAMES})


# ---------------------------------------------------------------- files


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _states(spark: SparkSession, base: str) -> list[str]:
    return [n for n in _children(spark, f"{base}/_manifests") if n.endswith(".json")]


def manifest(spark: SparkSession, base: str) -> dict:
    """The last published state: ``{"number": n, "datasets": {...}}``; number 0 if none."""
    states = _states(spark, base)
    if not states:
        return {"number": 0, "datasets": {}}
    fs, p = _fs(spark, f"{base}/_manifests/{states[-1]}")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, base: str, state: dict) -> None:
    """The switch: the state's file is written aside and renamed into place, if it is free."""
    fs, aside = _fs(spark, f"{base}/_manifests/.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    _, place = _fs(spark, f"{base}/_manifests/{state['number']:08d}.json")
    if fs.exists(place) or not fs.rename(aside, place):
        fs.delete(aside, False)
        raise Conflict(f"state {state['number']} of {base} was published by another run")


# ---------------------------------------------------------------- refresh and read


def refresh(
    spark: SparkSession,
    sources: Sources,
    params: Params,
    base: str,
    names: Iterable[str] = tuple(DATED),
) -> dict[str, list[str]]:
    """Recompute the changed dates of the datasets and publish; dates recomputed per dataset."""
    names = list(names)
    unknown = [n for n in names if n not in DATED]
    if unknown:
        raise ValueError(f"not refreshed by date: {unknown}")
    base = base.rstrip("/")
    old = manifest(spark, base)
    used = sorted({s for n in names for s in DATED[n]})
    prints = fingerprints(sources, params, used)
    datasets = dict(old["datasets"])
    changed: dict[str, list[str]] = {}
    run = uuid.uuid4().hex
    pipelines: dict[tuple[str, ...], Pipeline] = {}
    for name in names:
        wanted = _wanted(prints, DATED[name], params)
        have = datasets.get(name, {"days": {}})["days"]
        stale = [d for d, fp in wanted.items() if have.get(d, {}).get("print") != fp]
        changed[name] = stale
        days = {d: have[d] for d in wanted if d not in stale}
        schema = datasets.get(name, {}).get("schema")
        if stale or schema is None:
            key = tuple(stale)
            if key not in pipelines:  # datasets that lack the same dates share a plan
                part = sources if len(stale) == len(wanted) else _of_days(sources, stale, params)
                pipelines[key] = Pipeline(part, params)
            df = getattr(pipelines[key], name)
            schema = json.loads(df.schema.json())
            place = f"data/{run}/{name}"
            write_table(df.withColumn("day", F.col("date")), path=f"{base}/{place}", partition_by=("day",))
            written = set(_children(spark, f"{base}/{place}"))
            for d in stale:
                folder = f"day={d}"
                days[d] = {
                    "print": wanted[d],
                    "path": f"{place}/{folder}" if folder in written else None,
                }
        datasets[name] = {"schema": schema, "days": dict(sorted(days.items()))}
    if datasets != old["datasets"]:
        _publish(spark, base, {"number": old["number"] + 1, "datasets": datasets})
    return changed


def published(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A dataset as the last published state has it."""
    base = base.rstrip("/")
    entry = manifest(spark, base)["datasets"].get(name)
    if entry is None:
        raise ValueError(f"{name} is not published under {base}")
    schema = T.StructType.fromJson(entry["schema"])
    paths = [f"{base}/{d['path']}" for d in entry["days"].values() if d["path"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def expire(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` states and the runs' folders that none of them lists.

    To be run when no refresh is under way: its folders are not listed yet.
    """
    if keep < 1:
        raise ValueError("the last state stays")
    base = base.rstrip("/")
    states = _states(spark, base)
    for old in states[:-keep]:
        fs, p = _fs(spark, f"{base}/_manifests/{old}")
        fs.delete(p, False)
    listed = set()
    for state in states[-keep:]:
        fs, p = _fs(spark, f"{base}/_manifests/{state}")
        stream = fs.open(p)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        for entry in json.loads(text)["datasets"].values():
            listed |= {d["path"].split("/")[1] for d in entry["days"].values() if d["path"]}
    gone = [r for r in _children(spark, f"{base}/data") if r not in listed]
    for r in gone:
        fs, p = _fs(spark, f"{base}/data/{r}")
        fs.delete(p, True)
    return gone

"""Interval operators: run profile (D7/D8 + F3/F4), config periods (W1/W2),
effective-dated join (D17).

Run profile
-----------
A sample counts for a run when it has the run's date, workspace and cluster,
starts at or after the run's minute floor and ends at or before its minute
ceiling.  Spark has no range-join index, so a plain equi-join on
(date, workspace, cluster) with the range as a residual compares every run of
a cluster-day with every sample of it — quadratic on a hot cluster-day.  The
plan here instead

1. pre-aggregates samples per (date, workspace, cluster, role, start minute,
   end minute) — exact because run windows are minute-aligned — with
   min / max / sum / count per metric; partial aggregation runs map-side, so
   all nodes of a cluster sampling a minute collapse to ~one row per role
   before the shuffle;
2. profiles each distinct run window (date, workspace, cluster, floor,
   ceiling) once, whatever the number of runs sharing it;
3. adds a time bucket of the sample start to the equi keys: a window is
   exploded into the buckets it covers (at most ``86400 / bucket_seconds``
   per day with ``same_date``), and a contained sample's start minute lies in
   exactly one of them, so the result is exact.  A bucket that lies wholly
   inside the window is met at bucket level: one row per role holds all
   samples that end in it, and only samples that cross its end are met minute
   by minute; the (at most two) buckets at the window's edges meet the minute
   rows.  So a window meets about two rows per covered bucket, plus the
   minutes of its edges, whatever its length and the data volume;
   Where windows may span days (``same_date`` off), the buckets inside are met in
   dyadic blocks: a block of level j holds 2^j buckets and one row per role, and a
   window is covered by at most two blocks per level, so a month costs some twenty
   rows instead of one per bucket;
4. merges the partial aggregates per window and left-joins them back to the
   runs, so runs without samples keep null profiles.

Effective-dated join
--------------------
Config periods come from ``lead`` over one row per cluster and change day
(bounded by the number of days); the period in force is found by an as-of
lookup over the distinct fact days and period start days of a cluster
(bounded by the number of days), then equi-joined back to the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens.functions.exact import exact_parts, exact_total
from costlens.params import Params
from costlens.sources.adapters import BYTES, METRICS

WINDOW_KEY = ["date", "workspace_id", "cluster_id", "run_start_floor", "run_term_ceil"]
ROLES = {"driver": (True, "d_"), "worker": (False, "w_")}
_METRIC_NAMES = [dst for _, dst in METRICS]
_BYTE_NAMES = [dst for _, dst in BYTES]


def profile_columns(roles: Sequence[str] = ("driver", "worker")) -> list[str]:
    cols = []
    for role in roles:
        prefix = ROLES[role][1]
        for m in _METRIC_NAMES:
            cols += [f"min_{prefix}{m}", f"avg_{prefix}{m}", f"max_{prefix}{m}"]
        cols += [f"sum_{prefix}{b}" for b in _BYTE_NAMES]
    return cols


def _bucket(ts: Column, width: int) -> Column:
    return F.floor(F.unix_seconds(ts) / F.lit(width))


def _minute_ceil(ts: Column) -> Column:
    floor = F.date_trunc("minute", ts)
    return F.when(floor == ts, floor).otherwise(F.timestamp_add("MINUTE", F.lit(1), floor))


def _sample_partials(samples: DataFrame, p: Params, roles: Sequence[str]) -> DataFrame:
    """Samples collapsed per (date, workspace, cluster, role, start minute, end minute).

    Run windows are minute-aligned (floor and ceiling of the run), so
    ``start >= floor`` holds exactly when the start's minute floor does, and
    ``end <= ceiling`` exactly when the end's minute ceiling does.  Grouping
    by the two minute marks is therefore exact and bounds the rows per
    cluster-minute and role by the number of distinct sample lengths (about
    one or two), whatever the number of nodes or their second offsets.
    """
    flags = [ROLES[r][0] for r in roles]
    s = samples.where(
        F.col("driver").isin(*flags) & F.col("start_time").isNotNull() & F.col("end_time").isNotNull()
    )
    aggs = []
    for m in _METRIC_NAMES:
        aggs += [
            F.min(m).alias(f"mn_{m}"),
            F.max(m).alias(f"mx_{m}"),
            *exact_parts(F.col(m), f"sm_{m}"),
            F.count(m).alias(f"n_{m}"),
        ]
    aggs += [F.sum(b).alias(f"sb_{b}") for b in _BYTE_NAMES]
    keys = [
        "date",
        "workspace_id",
        "cluster_id",
        "driver",
        F.date_trunc("minute", F.col("start_time")).alias("_a"),
        _minute_ceil(F.col("end_time")).alias("_e"),
    ]
    return (
        s.groupBy(*keys)
        .agg(*aggs)
        .withColumn("_bucket", _bucket(F.col("_a"), p.bucket_seconds))
    )


# Which rows a window meets in a bucket: those of a bucket inside it, of one at
# its edge, and samples that cross the bucket's end (met by both).
_WHOLE, _EDGE, _CROSS = 0, 1, 2


def _two_levels(minutes: DataFrame, p: Params) -> DataFrame:
    """Minute partials plus one row per bucket and role over the samples that end in it."""
    begin = F.timestamp_seconds(F.col("_bucket") * p.bucket_seconds)
    end = F.timestamp_seconds((F.col("_bucket") + 1) * p.bucket_seconds)
    inside = F.array(
        F.struct(F.lit(_EDGE).alias("level"), F.col("_a").alias("a"), F.col("_e").alias("e")),
        F.struct(F.lit(_WHOLE).alias("level"), begin.alias("a"), end.alias("e")),
    )
    cross = F.array(
        F.struct(F.lit(_CROSS).alias("level"), F.col("_a").alias("a"), F.col("_e").alias("e"))
    )
    rows = minutes.withColumn("_l", F.explode(F.when(F.col("_e") <= end, inside).otherwise(cross)))
    keys = ["date", "workspace_id", "cluster_id", "driver", "_bucket"]
    merge = {"mn_": F.min, "mx_": F.max}
    partials = [c for c in minutes.columns if c not in (*keys, "_a", "_e")]
    return rows.groupBy(
        *keys,
        F.col("_l.level").alias("_level"),
        F.col("_l.a").alias("_a"),
        F.col("_l.e").alias("_e"),
    ).agg(*[merge.get(c[:3], F.sum)(c).alias(c) for c in partials])


def _window_buckets(runs: DataFrame, p: Params) -> DataFrame:
    """Distinct run windows: per time bucket they can hold samples in, the levels they meet."""
    w = runs.select(*WINDOW_KEY).where(
        F.col("run_start_floor").isNotNull() & F.col("run_term_ceil").isNotNull()
    ).distinct()
    lo = _bucket(F.col("run_start_floor"), p.bucket_seconds)
    hi = _bucket(F.col("run_term_ceil"), p.bucket_seconds)
    if p.same_date:
        day_start = F.col("date").cast("timestamp")
        day_last = F.timestamp_add("SECOND", F.lit(86399), day_start)
        lo = F.greatest(lo, _bucket(day_start, p.bucket_seconds))
        hi = F.least(hi, _bucket(day_last, p.bucket_seconds))
    w = w.select("*", lo.alias("_lo"), hi.alias("_hi")).where(F.col("_lo") <= F.col("_hi"))
    w = w.select(*WINDOW_KEY, F.explode(F.sequence("_lo", "_hi")).alias("_bucket"))
    inside = (
        F.timestamp_seconds(F.col("_bucket") * p.bucket_seconds) >= F.col("run_start_floor")
    ) & (
        F.timestamp_seconds((F.col("_bucket") + 1) * p.bucket_seconds) <= F.col("run_term_ceil")
    )
    level = F.when(inside, F.lit(_WHOLE)).otherwise(F.lit(_EDGE))
    return w.withColumn("_level", F.explode(F.array(level, F.lit(_CROSS))))


# Levels of dyadic blocks: 2^12 buckets of an hour are 170 days; a longer window takes
# one block of the highest level per 170 days.
MAX_LEVEL = 12


def _block_levels(levels: DataFrame, p: Params) -> DataFrame:
    """The rows of ``_two_levels`` as blocks of 2^j buckets, j = 0 .. ``MAX_LEVEL``.

    A block's row holds all samples that begin and end in it; a sample that crosses
    the block's end is met by itself.  Bucket rows are merged upwards, so the work
    grows with buckets, not samples.  Samples of any date count, so the date goes.
    """
    up = F.explode(F.sequence(F.lit(0), F.lit(MAX_LEVEL))).alias("_j")
    rows = levels.where(F.col("_level") != _EDGE).select("*", up)
    rows = rows.withColumn("_block", F.floor(F.col("_bucket") / F.pow(F.lit(2), F.col("_j"))))
    width = F.lit(p.bucket_seconds) * F.pow(F.lit(2), F.col("_j")).cast("long")
    begin = F.timestamp_seconds(F.col("_block") * width)
    end = F.timestamp_seconds((F.col("_block") + 1) * width)
    inside = F.col("_e") <= end
    keys = ["workspace_id", "cluster_id", "driver", "_j", "_block"]
    level = F.when(inside, F.lit(_WHOLE)).otherwise(F.lit(_CROSS))
    rows = rows.select(
        *[c for c in rows.columns if c not in ("date", "_bucket", "_level", "_a", "_e")],
        level.alias("_level"),
        F.when(inside, begin).otherwise(F.col("_a")).alias("_a"),
        F.when(inside, end).otherwise(F.col("_e")).alias("_e"),
    )
    merge = {"mn_": F.min, "mx_": F.max}
    partials = [c for c in rows.columns if c not in (*keys, "_level", "_a", "_e")]
    merged = rows.groupBy(*keys, "_level", "_a", "_e").agg(
        *[merge.get(c[:3], F.sum)(c).alias(c) for c in partials]
    )
    # The minute rows of buckets at the edges of a window stay as they are.
    edges = levels.where(F.col("_level") == _EDGE).drop("date")
    edges = edges.withColumn("_j", F.lit(0)).withColumnRenamed("_bucket", "_block")
    return merged.unionByName(edges)


_PIECES = "array<struct<j:int,block:bigint,level:int>>"


def _top_piece(j: int, level: int):
    return lambda b: F.struct(F.lit(j).alias("j"), b.alias("block"), F.lit(level).alias("level"))


def _window_blocks(runs: DataFrame, p: Params) -> DataFrame:
    """Distinct run windows: the blocks they meet, two per level at most, and the edges."""
    w = runs.select(*WINDOW_KEY).where(
        F.col("run_start_floor").isNotNull() & F.col("run_term_ceil").isNotNull()
    ).distinct()
    w = w.select(
        "*",
        _bucket(F.col("run_start_floor"), p.bucket_seconds).alias("_lo"),
        _bucket(F.col("run_term_ceil"), p.bucket_seconds).alias("_hi"),
    ).where(F.col("_lo") <= F.col("_hi"))
    # Buckets wholly inside: from the first that begins in the window up to the last that ends in it.
    starts_in = F.timestamp_seconds(F.col("_lo") * p.bucket_seconds) >= F.col("run_start_floor")
    first = F.when(starts_in, F.col("_lo")).otherwise(F.col("_lo") + 1)
    w = w.select("*", first.alias("_first"), F.col("_hi").alias("_end"))  # [_first, _end) is inside

    def piece(j, block, level, when):
        return F.when(
            when,
            F.struct(F.lit(j).alias("j"), block.cast("long").alias("block"), F.lit(level).alias("level")),
        )

    pieces, tops = [], []
    for j in range(MAX_LEVEL + 1):
        left = F.ceil(F.col("_first") / F.lit(2**j)).cast("long")
        right = F.floor(F.col("_end") / F.lit(2**j)).cast("long")
        for level in (_WHOLE, _CROSS):
            if j < MAX_LEVEL:
                pieces.append(piece(j, left, level, (left < right) & (F.pmod(left, F.lit(2)) == 1)))
                pieces.append(piece(j, right - 1, level, (left < right) & (F.pmod(right, F.lit(2)) == 1)))
            else:
                every = F.sequence(left, right - 1)
                every = F.transform(every, _top_piece(j, level))
                tops.append(F.when(left < right, every).otherwise(F.array().cast(_PIECES)))
    lo, hi = F.col("_lo"), F.col("_hi")
    for level in (_EDGE, _CROSS):
        pieces.append(piece(0, lo, level, lo < F.col("_first")))
        pieces.append(piece(0, hi, level, (hi != lo) | (F.col("_first") == lo)))
    listed = F.concat(F.filter(F.array(*pieces), lambda x: x.isNotNull()), *tops)
    return w.select(*WINDOW_KEY, F.explode(listed).alias("_p")).select(
        *WINDOW_KEY,
        F.col("_p.j").alias("_j"),
        F.col("_p.block").alias("_block"),
        F.col("_p.level").alias("_level"),
    )


def window_profile(
    runs: DataFrame, samples: DataFrame, p: Params, roles: Sequence[str] = ("driver", "worker")
) -> DataFrame:
    """Profile aggregates per distinct run window (only windows with samples)."""
    levels = _two_levels(_sample_partials(samples, p, roles), p)
    if p.same_date:
        wb, sp, met = _window_buckets(runs, p), levels, ["date", "_bucket", "_level"]
    else:
        wb, sp, met = _window_blocks(runs, p), _block_levels(levels, p), ["_j", "_block", "_level"]
    wb, sp = wb.alias("w"), sp.alias("s")
    cond = (F.col("s._a") >= F.col("w.run_start_floor")) & (F.col("s._e") <= F.col("w.run_term_ceil"))
    for k in ("workspace_id", "cluster_id", *met):
        cond = cond & (F.col(f"w.{k}") == F.col(f"s.{k}"))
    joined = wb.join(sp, cond, "inner").select(
        *[F.col(f"w.{k}").alias(k) for k in WINDOW_KEY],
        F.col("s.driver").alias("driver"),
        *[F.col(f"s.{c}") for c in sp.columns if c[:3] in ("mn_", "mx_", "sm_") or c[:2] == "n_"],
        *[F.col(f"s.sb_{b}") for b in _BYTE_NAMES],
    )
    aggs = []
    for role in roles:
        flag, prefix = ROLES[role]
        mine = F.col("driver") == F.lit(flag)

        def total_of_mine(part: str, mine: Column = mine) -> Column:
            return F.sum(F.when(mine, F.col(part)))

        for m in _METRIC_NAMES:
            aggs += [
                F.min(F.when(mine, F.col(f"mn_{m}"))).alias(f"min_{prefix}{m}"),
                F.try_divide(
                    exact_total(f"sm_{m}", total_of_mine), F.sum(F.when(mine, F.col(f"n_{m}")))
                ).alias(f"avg_{prefix}{m}"),
                F.max(F.when(mine, F.col(f"mx_{m}"))).alias(f"max_{prefix}{m}"),
            ]
        aggs += [
            F.sum(F.when(mine, F.col(f"sb_{b}"))).alias(f"sum_{prefix}{b}") for b in _BYTE_NAMES
        ]
    return joined.groupBy(*WINDOW_KEY).agg(*aggs)


def run_profile(
    runs: DataFrame, samples: DataFrame, p: Params, roles: Sequence[str] = ("driver", "worker")
) -> DataFrame:
    """Runs with min/avg/max of five percents and two byte sums per role.

    ``samples`` is the role-flagged timeline (adapter ``timeline``).  Every
    input row is kept once; a run without contained samples gets nulls.
    """
    prof = window_profile(runs, samples, p, roles)
    out = runs.join(prof, WINDOW_KEY, "left")
    return out.select(*runs.columns, *profile_columns(roles))


# Config periods and the effective-dated join ------------------------------------
CLUSTER_KEY = ["workspace_id", "cluster_id"]
_TIE_BREAK = (
    "auto_termination_minutes",
    "worker_count",
    "min_autoscale_workers",
    "max_autoscale_workers",
    "cluster_name",
    "driver_node_type",
    "worker_node_type",
    "runtime_version",
    "cluster_source",
    "create_time",
    "delete_time",
    "account_id",
)


def config_periods(configs: DataFrame) -> DataFrame:
    """Each configuration row with ``valid_to`` = next change day - 1.

    Rows are ordered by (change_date, change_time) and, for full ties, by the
    configuration values, so the result does not depend on partitioning.  Only
    the last change of a day owns a non-empty period; earlier ones of the same
    day get ``valid_to = change_date - 1``.  ``lead`` runs over one row per
    cluster and change day, so a window partition holds at most one row per
    calendar day.
    """
    configs = configs.distinct()
    order = ["change_time", *[c for c in _TIE_BREAK if c in configs.columns]]
    last = configs.groupBy(*CLUSTER_KEY, "change_date").agg(
        F.max(F.struct(*order)).alias("_last")
    )
    nxt = F.lead("change_date").over(Window.partitionBy(*CLUSTER_KEY).orderBy("change_date"))
    day_key = [*CLUSTER_KEY, "change_date"]
    days = last.select(
        *[F.col(k).alias("_k_" + k) for k in day_key], "_last", F.date_sub(nxt, 1).alias("_next_end")
    )
    # Null-safe: rows with a null key form their own partition, as with ``lead``.
    cond = None
    for k in day_key:
        c = configs[k].eqNullSafe(days["_k_" + k])
        cond = c if cond is None else cond & c
    out = configs.join(days, cond, "left")
    owner = F.struct(*order).eqNullSafe(F.col("_last"))
    valid_to = F.when(owner, F.col("_next_end")).otherwise(F.date_sub("change_date", 1))
    return out.select(*[configs[c] for c in configs.columns], valid_to.alias("valid_to"))


def effective_join(
    facts: DataFrame,
    periods: DataFrame,
    date_col: str = "date",
    keys: Sequence[str] = CLUSTER_KEY,
) -> DataFrame:
    """Attach the period in force on each fact's date (left join).

    An as-of lookup instead of a range join: the distinct (key, day) pairs of
    the facts are unioned with the start days of the non-empty periods, and
    ``last(period, ignorenulls)`` over the rows of a cluster ordered by day
    picks the period started last on or before each day.  A window partition
    holds at most one fact row and one period start per calendar day, so the
    cost is linear and bounded per cluster whatever the data volume; the
    result is equi-joined back to the facts.  Periods of one cluster do not
    overlap (``config_periods``), so a fact row never fans out.

    Fact keys are kept (the reference nulls them for unmatched rows, X7); the
    period's own key columns are not repeated.  Null keys never match.
    """
    keys = list(keys)
    period_cols = [c for c in periods.columns if c not in keys]
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    live = periods.where(
        not_null
        & F.col("change_date").isNotNull()
        & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("change_date")))
    )
    starts = live.select(*keys, F.col("change_date").alias("_d"), F.struct(*period_cols).alias("_p"))
    days = (
        facts.where(not_null & F.col(date_col).isNotNull())
        .select(*keys, F.col(date_col).alias("_d"))
        .distinct()
    )
    both = days.unionByName(starts, allowMissingColumns=True)
    w = (
        Window.partitionBy(*keys)
        .orderBy(F.col("_d"), F.col("_p").isNull())  # a period starting on a day applies to it
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cur = both.select(
        *keys, "_d", F.col("_p").isNull().alias("_fact"), F.last("_p", ignorenulls=True).over(w).alias("_cur")
    )
    in_force = F.col("_cur").isNotNull() & (
        F.col("_cur.valid_to").isNull() | (F.col("_d") <= F.col("_cur.valid_to"))
    )
    matched = cur.where(F.col("_fact") & in_force).select(
        *keys, F.col("_d").alias(date_col), *[F.col(f"_cur.{c}").alias(c) for c in period_cols]
    )
    out = facts.join(matched, [*keys, date_col], "left")
    return out.select(*facts.columns, *period_cols)

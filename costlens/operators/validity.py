"""Dated lines as validity intervals.

A dimension table with a row per key and day mostly repeats itself.  ``periods``
keeps its changes only: the days of a key fall into versions, a version being a
longest stretch of consecutive days with the same set of lines, and every line
of a version becomes one row with ``valid_from`` and ``valid_to``.  Two versions
of a key never overlap, so the version in force on a day is an as-of lookup, and
``lines`` gives back the daily rows exactly.

No window holds more than one row per calendar day of a line or a key, and
nothing is compared as a range: a hot key's rows meet their versions in equi joins
that adaptive execution may split.

Defined results: repeated lines count once; null dimensions are values like
others; lines with a null key are kept by ``periods`` and ``lines`` and met by
no fact; a null date is on no day, so such lines drop out; days without any line
belong to no version; an empty table gives empty periods.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FROM, TO = "valid_from", "valid_to"


def _same(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for left, right in pairs:
        cond = cond & a[left].eqNullSafe(b[right])
    return cond


def periods(daily: DataFrame, keys: Sequence[str], date_col: str = "date") -> DataFrame:
    """One row per version of a key and line in it: the columns but ``date_col``, and the interval."""
    keys = list(keys)
    values = [c for c in daily.columns if c != date_col]
    daily = daily.where(F.col(date_col).isNotNull()).distinct()
    one_line = Window.partitionBy(*values).orderBy(date_col)
    day, before, after = F.col(date_col), F.col("_before"), F.col("_after")
    neighbours = daily.select(
        *keys,
        date_col,
        F.lag(date_col).over(one_line).alias("_before"),
        F.lead(date_col).over(one_line).alias("_after"),
    )
    # Where a line begins, and on the day after it ends, a version of its key begins.
    new = F.when(before.isNull() | (before < F.date_sub(day, 1)), day)
    ended = F.when(after.isNull() | (after > F.date_add(day, 1)), F.date_add(day, 1))
    marks = neighbours.select(
        *keys, day.alias("_day"), F.explode(F.array(F.lit(None), new, ended)).alias("_mark")
    )
    days = marks.where("_mark is null").select(*keys, "_day", F.lit(False).alias("_begins"))
    begins = marks.where("_mark is not null").select(*keys, F.col("_mark").alias("_day"), F.lit(True).alias("_begins"))
    days = days.unionByName(begins).groupBy(*keys, "_day").agg(F.bool_or("_begins").alias("_begins"))
    so_far = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    versions = days.select(
        *[F.col(k).alias("_k_" + k) for k in keys],
        "_day",
        F.last(F.when(F.col("_begins"), F.col("_day")), ignorenulls=True).over(so_far).alias(FROM),
    )
    pairs = [*[(k, "_k_" + k) for k in keys], (date_col, "_day")]
    placed = daily.join(versions, _same(daily, versions, pairs))
    return placed.groupBy(*values, FROM).agg(F.max(date_col).alias(TO))


def lines(table: DataFrame, date_col: str = "date") -> DataFrame:
    """The daily rows that ``periods`` was made of."""
    values = [c for c in table.columns if c not in (FROM, TO)]
    return table.select(F.explode(F.sequence(FROM, TO)).alias(date_col), *values)


def in_force(facts: DataFrame, table: DataFrame, keys: Sequence[str], date_col: str = "date") -> DataFrame:
    """The lines in force on the (key, day) pairs of ``facts``: ``keys``, ``date_col``, other columns.

    The distinct days of the facts and the starts of the versions are ordered by day
    per key (one row per day each), and the last start on or before a day, if its
    version has not ended, names the version whose lines are met by an equi join.
    """
    keys = list(keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    dims = [c for c in table.columns if c not in (*keys, FROM, TO)]
    days = facts.where(known & F.col(date_col).isNotNull()).select(*keys, F.col(date_col).alias("_day")).distinct()
    starts = (
        table.where(known)
        .select(*keys, F.col(FROM).alias("_day"), F.struct(FROM, TO).alias("_version"))
        .distinct()
    )
    so_far = (
        Window.partitionBy(*keys)
        .orderBy(F.col("_day"), F.col("_version").isNull())  # a version applies to its first day
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    looked_up = days.unionByName(starts, allowMissingColumns=True).select(
        *keys,
        "_day",
        F.col("_version").isNull().alias("_fact"),
        F.last("_version", ignorenulls=True).over(so_far).alias("_now"),
    )
    met = looked_up.where(F.col("_fact") & (F.col("_day") <= F.col(f"_now.{TO}"))).select(
        *keys, F.col("_day").alias(date_col), F.col(f"_now.{FROM}").alias(FROM)
    )
    return met.join(table, [*keys, FROM]).select(*keys, date_col, *dims)

"""Sums of doubles that do not depend on the order of rows.

Doubles do not add associatively, so a plain ``sum`` or ``avg`` differs in its last digits
with the partitioning.  Here each value is split, row by row, into whole numbers on a fixed
grid of 2^-60: those add as bigints, without rounding and in any order, and merge like
sums do.  One rounding follows at the end.

A value of at least 2^-8 is kept whole; a smaller one is rounded to the grid, to within
2^-61 on its own.  Values of 2^30 and above, NaN and infinities lie outside the grid and are
added as doubles beside it.  A group holds up to 2^32 values; beyond that a sum of bigints
raises an overflow error in ANSI mode.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = ("whole", "mid", "low", "over")
_LIMIT = float(2**30)
_GRID = float(2**60)
_MASK = 2**30 - 1


def part_names(name: str) -> list[str]:
    return [f"{name}_{part}" for part in PARTS]


def exact_parts(x: Column, name: str, times: Column | None = None) -> list[Column]:
    """The aggregates that hold the sum of the double ``x``, each value counted ``times``
    times.  Null where no value is; merge them by ``sum``."""
    fits = F.abs(x) < F.lit(_LIMIT)  # NaN compares as the largest value
    v = F.when(x.isNotNull(), F.when(fits, x).otherwise(F.lit(0.0)))
    whole = F.floor(v)
    steps = F.rint((v - whole) * F.lit(_GRID)).cast("bigint")
    over = F.when(~fits, x)
    parts = (whole, F.shiftright(steps, 30), steps.bitwiseAND(F.lit(_MASK)), over)
    if times is not None:
        parts = tuple(part * times for part in parts)
    return [F.sum(part).alias(n) for part, n in zip(parts, part_names(name))]


def exact_total(name: str, of: Callable[[str], Column] = F.col) -> Column:
    """The sum as a double from its merged parts; ``of`` gives the column of a part."""
    whole, mid, low, over = (of(n) for n in part_names(name))
    mid = mid + F.shiftright(low, 30)
    steps = F.shiftleft(mid.bitwiseAND(F.lit(_MASK)), 30) + low.bitwiseAND(F.lit(_MASK))
    total = (whole + F.shiftright(mid, 30)).cast("double") + steps.cast("double") / F.lit(_GRID)
    return total + F.coalesce(over, F.lit(0.0))

"""Exact medians and quartiles without sorting a column in one task.

A rank is found by refinement: a histogram over the range that holds it (a bounded number of
rows), then over the bin that holds it, between the bin's own smallest and largest value, until
few different values are left or only one. Every pass is one aggregation with partial sums;
the driver sees bins, never rows.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of a histogram, and the different values that are listed instead of being refined.
BINS, LISTED = 1024, 2048


def _bin(value: Column, low: float, high: float, bins: int) -> Column:
    """A number that never falls as the value rises; the ends of the range differ. Quarters, as the
    range itself may be no double."""
    span = 0.25 * high - 0.25 * low
    if not (0 < span < math.inf):  # subnormal, or with an infinite end
        return F.when(value <= low, 0).when(value >= high, 2).otherwise(1).cast("long")
    share = (value * 0.25 - 0.25 * low) / F.lit(span)
    inner = F.least(F.floor(share * (bins - 2)).cast("long") + 1, F.lit(bins - 2).cast("long"))
    return F.when(value <= low, F.lit(0).cast("long")).when(
        value >= high, F.lit(bins - 1).cast("long")).otherwise(inner)


def order_statistics(df: DataFrame, column: str, ranks: list[int], low: float, high: float,
                     count: int, bins: int = BINS, listed: int = LISTED) -> dict[int, float]:
    """The values at ``ranks`` (from 0) of the ``count`` numbers of a column, which lie between
    ``low`` and ``high``."""
    number = F.col(column)
    found: dict[int, float] = {}
    # (low, high, numbers below, numbers within) -> ranks that fall within
    open_ranges = {(low, high, 0, count): sorted(set(ranks))} if ranks else {}
    while open_ranges:
        following: dict = {}
        for (lo, hi, below, within), wanted in open_ranges.items():
            if lo == hi:
                found.update({r: lo for r in wanted})
                continue
            inside = df.where((number >= lo) & (number <= hi))
            key = number if within <= listed else _bin(number, lo, hi, bins)
            parts = inside.groupBy(key.alias("k")).agg(
                F.count(F.lit(1)).alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi"))
            at = below
            rows = sorted(parts.collect(), key=lambda r: r.lo)
            for row in rows:
                mine = [r for r in wanted if at <= r < at + row.n]
                if mine:
                    following.setdefault((row.lo, row.hi, at, row.n), []).extend(mine)
                at += row.n
        open_ranges = following
    return found


def percentiles(df: DataFrame, column: str, shares: list[float], bins: int = BINS,
                listed: int = LISTED) -> list[float | None]:
    """The exact percentiles of the numbers in a column, between two of them in proportion; nulls
    and NaN do not count, and without any number all are None."""
    number = F.col(column)
    plain = df.select(number.cast("double").alias("_x")).where("_x IS NOT NULL AND NOT isnan(_x)")
    ends = plain.agg(F.count("_x").alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi")).first()
    if not ends.n:
        return [None] * len(shares)
    places = [share * (ends.n - 1) for share in shares]
    ranks = [r for p in places for r in (math.floor(p), math.ceil(p))]
    values = order_statistics(plain, "_x", ranks, ends.lo, ends.hi, ends.n, bins, listed)
    out = []
    for place in places:
        down, up = math.floor(place), math.ceil(place)
        a, b = values[down], values[up]
        out.append(a if a == b else (up - place) * a + (place - down) * b)
    return out

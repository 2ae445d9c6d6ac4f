"""Exact order statistics of a whole column, without bringing it together anywhere."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of a pass; the driver sees a row per bin that isn't empty.
BINS = 8192


def exact_median(df: DataFrame, value: str) -> float | None:
    """The median of a column of doubles, as ``F.median`` has it (nulls left out, NaN largest); None if there is none.

    Each pass counts values in equal bins between the least and the largest, and the next one goes on in
    the bin that holds the middle: a few passes over ``df``, which should be stored.  ``F.median`` brings
    all distinct values into one task.
    """
    x = F.col(value)
    d = df.select(x.cast("double").alias(value)).where(x.isNotNull())
    finite = ~F.isnan(x) & (F.abs(x) < math.inf)
    n, lo, hi = d.agg(F.count("*"), F.min(F.when(finite, x)), F.max(F.when(finite, x))).first()
    if not n:
        return None
    first, second = (n - 1) // 2, n // 2  # ranks from 0
    before = 0
    while True:
        scale = 1.0 if lo is None or hi - lo < math.inf else 0.5  # the difference may be too large for a double
        width = 0.0 if lo is None else hi * scale - lo * scale
        inner = F.floor((x * scale - F.lit(lo * scale)) / F.lit(width) * (BINS - 1)) if width > 0 else F.lit(0)
        place = F.when(F.isnan(x), BINS + 1).when(x == math.inf, BINS).when(x == -math.inf, -1).otherwise(inner).cast("int")
        told = sorted(d.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi")).collect())
        ends: list[float] = []
        for b in told:
            if before + b["n"] > first and not ends:
                lo, hi = b["lo"], b["hi"]
                if lo == hi or b["bin"] > BINS or width <= 0:
                    ends = [lo]
                elif before + b["n"] > second:
                    break  # both are in this bin: go on inside
                else:
                    ends = [hi]  # the last of its bin
                if before + b["n"] > second:
                    ends *= 2
            elif ends and len(ends) < 2:
                ends.append(b["lo"])
            before += b["n"]
        if ends:
            return ends[0] if first == second else 0.5 * ends[0] + 0.5 * ends[1]
        d = d.where(x.between(lo, hi))

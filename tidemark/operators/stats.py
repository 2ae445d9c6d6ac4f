"""Closed-form statistics of short daily series; the sums come from Spark, the formulas run on the driver."""

from __future__ import annotations

import math
from collections.abc import Sequence


def chi2_tail(x: float) -> float:
    """Survival function of chi-squared with one degree of freedom."""
    return math.erfc(math.sqrt(max(x, 0.0) / 2))


def log_ratio(counts: Sequence[float], expected: Sequence[float]) -> float:
    """Twice the log of how much likelier counts are under their own rates than under expected counts (0 log 0 = 0)."""
    return 2 * sum(n * math.log(n / e) for n, e in zip(counts, expected, strict=True) if n)


def kupiec(n: int, hits: int, alpha: float = 0.05) -> float | None:
    """p-value that violations come at rate alpha; null under 20 observations, 0 if none or all are hits."""
    if n < 20:
        return None
    return chi2_tail(log_ratio((hits, n - hits), (alpha * n, (1 - alpha) * n))) if 0 < hits < n else 0.0


def christoffersen(n: int, n00: int, n01: int, n10: int, n11: int) -> float | None:
    """p-value that violations are independent of the day before; null under 30 observations.

    The likelihood ratio of a two-state chain against independence is that of its table of transitions
    against the product of the table's margins.
    """
    if n < 30:
        return None
    total, after_none, after_hit = n00 + n01 + n10 + n11, n00 + n01, n10 + n11
    none, hit = n00 + n10, n01 + n11
    margins = [row * column / total if total else 0.0 for row in (after_none, after_hit) for column in (none, hit)]
    return chi2_tail(log_ratio((n00, n01, n10, n11), margins))


def hac_t(n: int, mean: float, products: list[float], lag: int) -> float | None:
    """t statistic with Bartlett weights; products[k] is the sum of centred values times those k before."""
    if n < max(10, lag + 2):
        return None
    most = min(lag, n - 2)
    long_run = products[0] / n + 2 * sum((1 - k / (most + 1)) * products[k] / n for k in range(1, most + 1))
    se = math.sqrt(max(long_run, 0.0) / n)
    return mean / se if se > 0 else None

"""Statements to quarters, trailing years, lags and forecasts known before each release."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions import median_of
from tidemark.operators import windows as W
from tidemark.plans.adapters import FLOWS, STOCKS

TARGETS = ("adj_np_ttm", "revenue_ttm")


def report_window() -> WindowSpec:
    return Window.partitionBy("security_id").orderBy("report_period")


def pivoted(items: DataFrame) -> DataFrame:
    """One row per (security, period, available_at) from long items; the last non-null value in item order."""
    last = F.max_by("value", F.when(F.col("value").isNotNull(), F.col("value")))
    return items.groupBy("security_id", "report_period", "available_at").pivot("item", [*FLOWS, *STOCKS]).agg(last)


def trailing(statements: DataFrame) -> DataFrame:
    """Cumulative flows to single quarters, trailing four-quarter sums, and lags 1, 4, 5 by report."""
    year = Window.partitionBy("security_id", F.year("report_period")).orderBy("report_period")
    single = []
    for c in FLOWS:
        before = F.lag(c).over(year)
        single.append(F.when((F.quarter("report_period") == 1) | before.isNull(), F.col(c)).otherwise(F.col(c) - before).alias(f"{c}_q"))
    d = statements.select("*", *single)
    d = d.select("*", *[W.rolling(F.col(f"{c}_q"), 4, 4, F.sum, report_window()).alias(f"{c}_ttm") for c in FLOWS])
    return d.select("*", *[F.lag(c, k).over(report_window()).alias(f"{c}_lag{k}") for c in [*(f"{c}_ttm" for c in FLOWS), *STOCKS] for k in (1, 4, 5)])


def forecasts(reports: DataFrame) -> DataFrame:
    """Trend ensemble from strictly earlier points (last value, its growth, four-point line), spread and error scale."""
    d = reports
    for c in TARGETS:
        h = F.collect_list(c).over(report_window().rowsBetween(Window.unboundedPreceding, -1))
        d = d.withColumn("_h", h)
        a, b, y0 = (F.try_element_at("_h", F.lit(-k)) for k in (1, 2, 4))
        growth = F.when(F.size("_h") >= 2, F.coalesce(a * F.try_divide(a, b), a))
        line = F.when(F.size("_h") >= 4, -0.5 * y0 + 0.5 * b + a)
        d = d.withColumn("_m", F.array_sort(F.filter(F.array(a, growth, line), lambda x: x.isNotNull())))
        n, mean = F.size("_m"), F.aggregate("_m", F.lit(0.0), lambda s, x: s + x) / F.size("_m")
        spread = F.sqrt(F.aggregate("_m", F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / n)
        d = d.withColumn(f"pre_{c}", median_of(F.col("_m"))).withColumn(f"disp_{c}", F.when(n >= 2, spread))
        d = d.withColumn(f"_e_{c}", F.lag(F.abs(F.col(c) - F.col(f"pre_{c}"))).over(report_window())).drop("_h", "_m")
    for c in TARGETS:
        e = W.rolling(F.col(f"_e_{c}"), 8, 3, lambda x: F.percentile(x, F.lit(0.5)), report_window())
        d = d.withColumn(f"scale_{c}", 1.4826 * e)
    return d.drop(*[f"_e_{c}" for c in TARGETS])

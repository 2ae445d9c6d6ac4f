"""Window operators over a security's own rows, and cross-sections of a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions import clip, median_of

SECURITY, DATE = "security_id", "trade_date"
ALL, NOW = Window.unboundedPreceding, Window.currentRow


def own(*order: str, key: str | None = SECURITY) -> WindowSpec:
    w = Window.partitionBy(key) if key else Window.partitionBy()
    return w.orderBy(*(order or (DATE,)))


def rows(n: int, w: WindowSpec | None = None) -> WindowSpec:
    """The last n rows, this one included."""
    return (own() if w is None else w).rowsBetween(-(n - 1), NOW)


def rolling(value: Column, n: int, least: int, how, w: WindowSpec | None = None) -> Column:
    """how(value) over n rows if at least ``least`` of them have a value."""
    frame = rows(n, w)
    return F.when(F.count(value).over(frame) >= least, how(value).over(frame))


def filled(value: Column, w: WindowSpec | None = None) -> Column:
    return F.last(value, ignorenulls=True).over((own() if w is None else w).rowsBetween(ALL, NOW))


def change(value: str, n: int, w: WindowSpec | None = None) -> Column:
    """Relative change over n rows; ``value`` has been filled forward where it may be null."""
    return F.try_divide(F.col(value), F.lag(value, n).over(own() if w is None else w)) - 1


def difference(value: str, n: int, w: WindowSpec | None = None) -> Column:
    return F.col(value) - F.lag(value, n).over(own() if w is None else w)


def compounded(ret: Column, w: WindowSpec | None = None, floor: float = -0.999999) -> Column:
    """Running product of 1 + return; a null return changes nothing, losses stop short of everything."""
    step = 1 + F.greatest(F.coalesce(ret, F.lit(0.0)), F.lit(floor))
    return F.product(step).over((own() if w is None else w).rowsBetween(ALL, NOW))


def rank_share(value: Column, *keys: str) -> Column:
    """Rank from 0 to 1 within the keys, ties averaged, null for null."""
    group = Window.partitionBy(*keys)
    same = Window.partitionBy(*keys, value)
    r = F.rank().over(group.orderBy(value.asc_nulls_last()))
    return F.when(value.isNotNull(), (r + (F.count(value).over(same) - 1) / 2) / F.count(value).over(group))


def rolling_rank_share(value: Column, n: int, least: int, w: WindowSpec | None = None) -> Column:
    """Where the last of n rows ranks among them, ties averaged."""
    held = F.collect_list(value).over(rows(n, w))
    below, same = F.size(F.filter(held, lambda z: z < value)), F.size(F.filter(held, lambda z: z == value))
    return F.when(value.isNotNull() & (F.size(held) >= least), (below + (same + 1) / 2) / F.size(held))


def expanding_z(df: DataFrame, value: str, order: str, least: int = 60, out: str = "z") -> DataFrame:
    """Robust score against strictly earlier rows: median and 1.4826 MAD, else the population deviation.

    For one row per date (a few thousand rows in all).
    """
    before = Window.partitionBy().orderBy(order).rowsBetween(ALL, -1)
    d = df.withColumn("_h", F.array_sort(F.collect_list(value).over(before))).withColumn("_n", F.size("_h"))
    d = d.withColumn("_m", median_of(F.col("_h")))
    d = d.withColumn("_g", F.array_sort(F.transform("_h", lambda z: F.abs(z - F.col("_m")))))
    d = d.withColumn("_d", 1.4826 * median_of(F.col("_g"))).withColumn("_s", F.stddev_pop(value).over(before))
    scale = F.when(F.col("_d") >= 1e-12, F.col("_d")).when(F.col("_s") > 1e-12, F.col("_s"))
    score = F.when((F.col("_n") >= least) & F.col(value).isNotNull(), (F.col(value) - F.col("_m")) / scale)
    return d.withColumn(out, score).drop("_h", "_n", "_m", "_g", "_d", "_s")


def cross_section_z(df: DataFrame, value: str, date: str, group: str | None = None, least: int = 20, out: str = "z") -> DataFrame:
    """Winsorised, optionally group-neutral robust score per date; dates with fewer values stay null."""
    x, by_date = F.col(value), Window.partitionBy(date)
    enough = F.count(x).over(by_date) >= least
    lo, hi = (F.percentile(x, F.lit(q)).over(by_date) for q in (0.025, 0.975))
    d = df.withColumn("_x", F.when(enough, clip(value, lo, hi)))
    if group:
        d = d.withColumn("_x", F.when(F.col(group).isNotNull(), F.col("_x") - F.median("_x").over(Window.partitionBy(date, group))))
    d = d.withColumn("_m", F.median("_x").over(by_date)).withColumn("_s", F.stddev_pop("_x").over(by_date))
    d = d.withColumn("_d", 1.4826 * F.median(F.abs(F.col("_x") - F.col("_m"))).over(by_date))
    scale = F.when(F.col("_d") >= 1e-12, F.col("_d")).when(F.col("_s") > 1e-12, F.col("_s"))
    return d.withColumn(out, (F.col("_x") - F.col("_m")) / scale).drop("_x", "_m", "_s", "_d")


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last in a total order."""
    w = Window.partitionBy(*keys).orderBy(*[o.desc_nulls_last() for o in order])
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
